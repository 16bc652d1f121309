import random
import re

import corpora
from punctua.llm import exact_dedup as operator


def expected(texts):
    groups = {}
    for i, text in enumerate(texts):
        text = text or ""
        groups.setdefault(corpora.sha(re.sub("[\x20\x09-\x0D]", "", text)), []).append((-len(text), i))
    return {i: (min(g)[1], len(g), digest) for digest, g in groups.items() for _, i in g}


def test_groups_match_brute_force(spark):
    rng = random.Random(1)
    texts = corpora.odd_texts(rng) + [corpora.prose(rng, 5) for _ in range(50)]
    texts += [texts[20]] * 300 + [texts[21] + " "] * 3
    found = operator.exact_groups(corpora.frame(spark, texts).repartition(7)).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.digest) for r in found} == expected(texts)
    assert sum(r.uid == r.keep_uid for r in found) == len(set(v[2] for v in expected(texts).values()))


def test_repeated_rows_and_null_ids(spark):
    docs = corpora.frame(spark, ["a b", "ab", "a b", "ab"], ids=[None, 3, 3, None])
    found = operator.exact_groups(docs).collect()
    assert {(r.keep_id, r.group_size) for r in found} == {(3, 4)}
    assert sum(r.uid == r.keep_uid for r in found) == 1


def test_empty_table(spark):
    assert operator.exact_groups(corpora.frame(spark, [])).collect() == []


def test_filter_inserts_deletes_and_overflows():
    rng = random.Random(2)
    digests = [corpora.sha(str(i)) for i in range(3000)]
    live = operator.LiveDigests(capacity=16)
    for digest in digests:
        assert live.find(digest) is None
        live.insert(digest, 1)
    assert live.filter.size * operator.SLOTS >= len(digests)
    gone = set(rng.sample(digests, 1000))
    assert all(live.delete(d) for d in gone) and not any(live.delete(d) for d in gone)
    assert all((live.find(d) is None) == (d in gone) for d in digests)
    assert live.count == len(dict(live.items())) == 2000


def test_false_hits_of_the_filter_are_verified():
    live = operator.LiveDigests()
    one, other = "0" * 48 + "0123456789abcdef", "f" * 48 + "0123456789abcdef"
    live.insert(one, 1)
    assert live.hash(other) in live.filter and live.find(other) is None


def test_batches_of_changes(spark):
    live = spark.createDataFrame([("aa" * 32, 2), ("bb" * 32, 1), ("cc" * 32, 5)], "digest string, rows long")
    changes = spark.createDataFrame(
        [("aa" * 32, -1), ("bb" * 32, -1), ("dd" * 32, 1), ("dd" * 32, 1), ("ee" * 32, -1)], "digest string, change int")
    found = {r.digest[:2]: r.rows for r in operator.apply_changes(live, changes).collect()}
    assert found == {"aa": 1, "cc": 5, "dd": 2}
