import random

import corpora
import pytest
from punctua.llm import mixing as operator


def water_filled(sizes):
    """Targets by repeated resharing: ``sizes`` is ``{source: words}``."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / total > 3 * sizes[s]]
        if not over:
            target.update({s: rest * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
        rest -= sum(3 * sizes[s] for s in over)
        open_ -= set(over)
    return target


def test_targets_and_taken_words(spark):
    rng = random.Random(3)
    sources = [rng.choice(["a", "b", "c", "d", None, "é", ""]) for _ in range(900)] + ["z"] * 600
    texts = [corpora.prose(rng, rng.randint(0, 40)) for _ in sources]
    texts[5], texts[6] = None, " "
    docs = corpora.frame(spark, texts, sources)
    rows = operator.mix(docs).collect()
    size = {i: len(corpora.WORD.findall(t or "")) for i, t in enumerate(texts)}
    totals = {}
    for i, s in enumerate(sources):
        totals[s] = totals.get(s, 0) + size[i]
    target, taken = water_filled(totals), {}
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.source_size == totals[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
        epochs = int(target[r.source] // totals[r.source])
        assert r.copies in (epochs, epochs + 1)  # complete epochs come first
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)
    again = operator.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)


def test_small_sources_stop_at_three_times_their_size(spark):
    texts, sources = ["w " * 1000, "w w", "w"], ["a", "b", "c"]
    found = {r.source: (r.target, r.taken) for r in operator.mix(corpora.frame(spark, texts, sources)).collect()}
    assert found["b"] == (6.0, 6) and found["c"] == (3.0, 3)
    assert found["a"][0] == 1003 - 9


def test_quality_weights_favour_good_documents(spark):
    texts = ["w w w w w"] * 800 + ["w"] * 2000
    sources = ["a"] * 800 + ["b"] * 2000
    quality = spark.createDataFrame([(i, i % 2) for i in range(800)] + [(3, None), (None, 1)], "doc_id long, quality int")
    rows = [r for r in operator.mix(corpora.frame(spark, texts, sources), quality).collect() if r.source == "a"]
    good = sum(r.taken for r in rows if r.doc_id % 2)
    assert good > 1.5 * sum(r.taken for r in rows if r.doc_id % 2 == 0)


def test_empty_table_and_only_empty_texts(spark):
    assert operator.mix(corpora.frame(spark, [])).collect() == []
    assert [r.taken for r in operator.mix(corpora.frame(spark, [None, "", " "])).collect()] == [0, 0, 0]


def test_repeated_rows(spark):
    rows = operator.mix(corpora.frame(spark, ["a b c"] * 6, ids=[1, 1, 1, None, None, 2])).collect()
    assert len(rows) == 6 and sum(r.taken for r in rows) == 18
