import random

import corpora
import pytest
from punctua.llm import near_dedup as operator


def shingle_set(text):
    words = [bytes(w, "utf-8").lower() for w in corpora.WORD.findall(text or "")]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def expected(texts, percent=85):
    sets = [shingle_set(t) for t in texts]
    linked = []
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                linked.append((i, j))
    return corpora.components(len(texts), linked), [len(s) for s in sets]


def check(spark, texts, parts=6):
    found = {r.doc_id: r for r in operator.near_groups(corpora.frame(spark, texts).repartition(parts)).collect()}
    groups, sizes = expected(texts)
    assert [found[i].component_id for i in range(len(texts))] == groups
    assert [found[i].n_shingles for i in range(len(texts))] == sizes
    assert sum(r.uid == r.keep_uid for r in found.values()) == len(set(groups))


def test_matches_brute_force(spark):
    rng = random.Random(7)
    texts = corpora.odd_texts(rng)
    for edits in range(12):  # similarities around the threshold
        text = corpora.prose(rng, 300)
        texts += [text, *corpora.near_copies(rng, text, 3, edits)]
    shared = corpora.prose(rng, 200)
    texts += [shared + " " + corpora.prose(rng, rng.randint(10, 120)) for _ in range(15)]
    texts += [corpora.prose(rng, 3)] * 40
    check(spark, texts)


def test_large_group_of_near_copies_is_branched_and_dealt(spark, monkeypatch):
    monkeypatch.setattr(operator, "BRANCH", 16)
    monkeypatch.setattr(operator, "MEETING", 8)
    monkeypatch.setattr(operator, "PIVOTS", 4)
    rng = random.Random(8)
    text = corpora.prose(rng, 200)
    texts = [text, *corpora.near_copies(rng, text, 120, 2), *corpora.near_copies(rng, text, 40, 4)]
    texts += corpora.near_copies(rng, text, 40, 12)  # share tokens with the group, most outside it
    check(spark, texts)


def test_strays_meet_all_members(spark, monkeypatch):
    monkeypatch.setattr(operator, "BRANCH", 8)
    monkeypatch.setattr(operator, "MEETING", 4)
    monkeypatch.setattr(operator, "PIVOTS", 0)
    monkeypatch.setattr(operator, "LEVELS", 0)
    rng = random.Random(9)
    text = corpora.prose(rng, 200)
    check(spark, [text, *corpora.near_copies(rng, text, 60, 2)])


def test_repeated_rows_null_ids_and_empty_table(spark):
    rng = random.Random(10)
    text = corpora.prose(rng, 50)
    rows = operator.near_groups(corpora.frame(spark, [text, text, text, None, "x"], ids=[None, 4, 4, 9, None])).collect()
    assert sorted((r.component_id or -1) for r in rows) == [-1, 4, 4, 4, 9]
    assert sum(r.uid == r.keep_uid for r in rows) == 3
    assert operator.near_groups(corpora.frame(spark, [])).collect() == []


def test_trees_reach_the_recall_asked():
    assert (1 - 0.85) ** operator.trees(85, 1e-9) <= 1e-9
    assert 30 <= operator.least_matches(85) < 54


@pytest.mark.parametrize("percent", [80, 100])
def test_other_thresholds(spark, percent):
    rng = random.Random(11)
    text = corpora.prose(rng, 150)
    texts = [text, *corpora.near_copies(rng, text, 8, 3), text]
    found = {r.doc_id: r.component_id for r in operator.near_groups(corpora.frame(spark, texts), percent).collect()}
    assert [found[i] for i in range(len(texts))] == expected(texts, percent)[0]


def test_no_member_is_twice_in_a_branch(spark, monkeypatch):
    monkeypatch.setattr(operator, "BRANCH", 1)
    rows = [(2 * g + i, [g * 100 + t for t in range(30)], bytes([g]) * 256) for g in range(100) for i in range(2)]
    nodes = spark.createDataFrame(rows, "uid long, heads array<long>, mark binary")
    _, large = operator._branches(nodes, 85)
    assert large.groupBy("key", "uid").count().where("count > 1").isEmpty()
    assert large.where("n > 2").isEmpty()


def test_members_of_a_known_component_are_not_compared_again():
    """A block of 300 near copies and two strays, one of which is like a member."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**32, operator.TOKENS, dtype=np.uint32)
    other = rng.integers(0, 2**32, operator.TOKENS, dtype=np.uint32)
    marks = [base.tobytes()] * 301 + [other.tobytes()]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5] * 302), pa.array(range(302)), pa.array([0] * 300 + [300, 301]), pa.array(marks, pa.binary())],
        names=["key", "uid", "component", "mark"])
    rows = [r for out in operator._candidates(85)([batch]) for r in out.to_pylist()]
    assert sorted(r["uid"] for r in rows) == list(range(301)) and {r["component"] for r in rows} == {0, 300}
    apart = batch.set_column(2, "component", pa.array([0] * 301 + [301]))
    assert sum(out.num_rows for out in operator._candidates(85)([apart])) == 0


def test_later_links_join_known_components(spark):
    parts = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5)], "node long, component long")
    more = spark.createDataFrame([(2, 6), (9, 8), (1, 2)], "a long, b long")
    found = operator._contracted(parts, more)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1), (2, 1), (5, 1), (6, 1), (8, 8), (9, 8)]
    assert operator._contracted(parts, more.where("a = 1")) is parts


def test_a_group_in_all_trees_is_joined_a_few_times_a_document(spark, monkeypatch):
    """Rows that joins on ``uid`` make for a group of near copies, at two sizes: not one per document, tree and level."""
    monkeypatch.setattr(operator, "BRANCH", 32)
    made, join_on = [], operator.join_on

    def counted(left, right, names, how="inner"):
        out = join_on(left, right, names, how)
        if names == ["uid"] and how == "inner":
            made.append(out.count())
        return out

    monkeypatch.setattr(operator, "join_on", counted)
    rng = random.Random(12)
    text = corpora.prose(rng, 200)
    texts = [text, *corpora.near_copies(rng, text, 399, 2)]
    rows = {}
    for size in (200, 400):
        made.clear()
        found = operator.near_groups(corpora.frame(spark, texts[:size])).collect()
        assert {r.component_id for r in found} == {0}
        rows[size] = sum(made)
    assert rows[400] <= 20 * 400 and rows[400] <= 2.5 * rows[200], rows


def test_a_group_does_not_go_through_all_levels(spark, monkeypatch):
    """Rows that joins on ``key`` make for a group of near copies, at two sizes: one level of all trees, not all levels."""
    monkeypatch.setattr(operator, "BRANCH", 32)
    made, join_on = [], operator.join_on

    def counted(left, right, names, how="inner"):
        out = join_on(left, right, names, how)
        if names == ["key"] and how == "inner":
            made.append(out.count())
        return out

    monkeypatch.setattr(operator, "join_on", counted)
    rng = random.Random(14)
    text = corpora.prose(rng, 200)
    texts = [text, *corpora.near_copies(rng, text, 399, 2)]
    rows = {}
    for size in (200, 400):
        made.clear()
        found = operator.near_groups(corpora.frame(spark, texts[:size])).collect()
        assert {r.component_id for r in found} == {0}
        rows[size] = sum(made)
    assert rows[400] <= 2.5 * operator.trees() * 400 and rows[400] <= 2.5 * rows[200], rows


def test_a_group_and_others_that_share_its_branches(spark, monkeypatch):
    """Near copies within a common passage, and pairs of others that are strays in the group's branches."""
    monkeypatch.setattr(operator, "BRANCH", 16)
    monkeypatch.setattr(operator, "PIVOTS", 4)
    rng = random.Random(15)
    common = corpora.prose(rng, 90)
    text = common + " " + corpora.prose(rng, 110)
    texts = [text, *corpora.near_copies(rng, text, 60, 2)]
    for _ in range(6):
        other = common + " " + corpora.prose(rng, 110)
        texts += corpora.near_copies(rng, other, 3, 2)
    texts += [common + " " + corpora.prose(rng, rng.randint(60, 110)) for _ in range(40)]
    rng.shuffle(texts)
    check(spark, texts)


def test_branches_with_a_main_component_are_settled(spark):
    """Of three large branches one has a main component, one none, and one too many strays."""
    rows = [(1, u, 12) for u in range(12)] + [(2, u, 6) for u in range(20, 26)] + [(3, u, 8) for u in [*range(30, 34), *range(40, 44)]]
    large = spark.createDataFrame(rows, "key long, uid long, n long")
    parts = spark.createDataFrame([(u, 0) for u in range(10)] + [(20, 20), (21, 20)] + [(30, 30), (31, 30)], "node long, component long")
    strays, others = operator._settled(large, parts)
    assert sorted(tuple(r) for r in strays.collect()) == [(0, 10), (0, 11)]
    assert {r.key for r in others.select("key").collect()} == {2, 3} and others.count() == 14
    strays, others = operator._settled(large.where("key > 1"), parts)
    assert strays.isEmpty() and others.count() == 14
    gathered = operator._gathered(spark.createDataFrame([(0, 10), (0, 11)], "main long, uid long"),
                                  spark.createDataFrame([(0, -1), (1, -1), (11, -1)], "node long, component long"))
    assert sorted(tuple(r) for r in gathered.collect()) == [(-1, 0, -1), (-1, 1, -1), (-1, 10, 10), (-1, 11, -1)]


def test_links_on_full_sets_match_brute_force():
    import numpy as np

    rng = np.random.default_rng(13)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    full = [np.unique(np.concatenate((rng.permutation(base)[:kept], rng.integers(0, 2**63, 300 - kept, dtype=np.uint64))))
            for kept in [*rng.integers(200, 300, 60).tolist(), 0, 0]]
    known = np.arange(62)
    known[[3, 4]] = 61
    links = [(3, 61), (4, 61)]
    for i, a in enumerate(full):
        for j, b in enumerate(full[:i]):
            common = len(np.intersect1d(a, b))
            if 100 * common >= 85 * (len(a) + len(b) - common):
                links.append((i, j))
    expected_groups = corpora.components(62, links)
    labels = operator.linked(full, known, 85).tolist()
    first = {}
    assert [first.setdefault(label, i) for i, label in enumerate(labels)] == expected_groups
    assert 3 < len(set(expected_groups)) < 60


def test_members_that_have_met_are_not_compared_again():
    import pyarrow as pa

    def groups(met):
        batch = pa.RecordBatch.from_arrays(
            [pa.array([5] * 4), pa.array(range(4)), pa.array(range(4)), pa.array([bytes(256)] * 4, pa.binary()), pa.array(met)],
            names=["key", "uid", "component", "mark", "met"])
        return [r["uid"] for out in operator._candidates(85)([batch]) for r in out.to_pylist()]

    assert groups([-7, -7, -7, -7]) == []
    assert groups([-7, -7, -7, 3]) == [0, 1, 2, 3]
