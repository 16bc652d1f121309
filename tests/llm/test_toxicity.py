import math
import random
import zlib
from collections import Counter
from pathlib import Path

import corpora
import numpy as np
import pytest
from punctua.llm import toxicity as operator

INSULTS = ["zorkel", "blimfar", "quonter", "hrasvil"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(18)
    texts, toxic = [], []
    for i in range(800):
        words = corpora.prose(rng, rng.randint(5, 120)).split()
        bad = i % 5 == 0
        for _ in range(rng.randint(1, 5) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "s", "ing", ",", "!"]))
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, toxic


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_accuracy_and_calibration(spark, corpus):
    texts, toxic = corpus
    extra = [None, "", " ", "zorkelish creatures", texts[0].upper()]
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in operator.scores(corpora.frame(spark, texts + extra), labels).collect()}
    assert len(rows) == len(texts) + len(extra)
    assert all(rows[i].held_out == held_out(i) and 0 <= rows[i].score <= 1 for i in rows)
    assert all(rows[i].predicted == (rows[i].score >= 0.5) for i in rows)
    test = [i for i in range(len(texts)) if held_out(i)]
    assert len(test) > 100
    assert np.mean([rows[i].predicted == toxic[i] for i in test]) > 0.98
    n = len(texts)
    assert rows[n].predicted == rows[n + 1].predicted == rows[n + 2].predicted == 0
    assert rows[n + 3].predicted == rows[n + 4].predicted == 1  # other ending, upper case
    assert rows[n + 4].evidence and rows[n].evidence == []


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(19)
    idf = rng.uniform(1, 3, 30)
    rows = []
    for i in range(700):
        terms = sorted(rng.choice(30, rng.integers(0, 6), replace=False).tolist())
        rows.append((i, int(rng.integers(2)), terms, rng.integers(1, 4, len(terms)).tolist()))
    index = operator.Examples.build(rows, idf)
    dense = np.zeros((700, 30))
    for i, _, terms, counts in rows:
        if terms:
            dense[i, terms] = operator.unit(terms, counts, idf)
    for i, _, terms, counts in rows[:80]:
        if not terms:
            continue
        found = index.nearest(terms, counts, 10, without=i)
        scores = dense @ dense[i]
        scores[i] = 0
        best = np.sort(scores[scores > 0])[::-1][:10]
        assert [s for s, _ in found] == pytest.approx(best.tolist())
        assert all(scores[index.texts[at]] == pytest.approx(s) for s, at in found)


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = operator.scores(corpora.frame(spark, ["a b", None], ids=[1, None]), none).collect()
    assert [(r.score, r.predicted) for r in rows] == [(0.0, 0)] * 2
    assert operator.scores(corpora.frame(spark, []), none).collect() == []


def test_one_class_only(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    rows = operator.scores(corpora.frame(spark, ["x y z"] * 20), labels).collect()
    assert {r.predicted for r in rows} == {0}


def plain_terms(text):
    found = Counter()
    for word in (text or "").split():
        letters = "".join(c for c in word.lower() if c.isalpha())
        if len(letters) >= 2:
            found[letters] += 1
        if len(letters) >= operator.STEM:
            found[letters[:operator.STEM] + "-"] += 1
    return found


def test_evidence_equals_dense_cosine_end_to_end(spark, corpus):
    """Frequencies over all texts, class ratios by hand, one dense product; also repeated, tied and very long texts."""
    texts, toxic = corpus[0][:240] + corpus[0][:30], corpus[1][:240] + corpus[1][:30]
    texts = texts + ["zorkel " + " ".join(texts) * 20, "unheardof", None]
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in operator.scores(corpora.frame(spark, texts), labels).collect()}
    counts = [plain_terms(text) for text in texts]
    frequency = Counter(term for found in counts for term in found)
    examples = {}
    for i, label in enumerate(toxic):
        if not held_out(i):
            examples[texts[i]] = max(label, examples.get(texts[i], 0))
    names = sorted({term for text in examples for term in plain_terms(text)})
    marked = [label for label in examples.values()]
    sets = [set(plain_terms(text)) for text in examples]
    weight = {}
    for term in names:
        table = Counter((term in found, label) for found, label in zip(sets, marked))
        ratio = 0.0
        for (has, label), seen in table.items():
            expected = sum(table[has, x] for x in (0, 1)) * sum(table[x, label] for x in (True, False)) / len(sets)
            ratio += 2 * seen * math.log(seen / expected)
        weight[term] = (math.log((1 + len(texts)) / (1 + frequency[term])) + 1) * (1 + max(0.0, ratio))

    def vector(found):
        dense = np.array([(1 + math.log(found[t])) * weight[t] if t in found else 0.0 for t in names])
        return dense / (np.linalg.norm(dense) or 1.0)

    dense = np.stack([vector(plain_terms(text)) for text in examples])
    for i, found in enumerate(counts):
        best = np.sort(dense @ vector(found))[::-1][:operator.NEIGHBOURS]
        assert [e.cosine for e in rows[i].evidence] == pytest.approx(best[best > 0].tolist(), abs=1e-9)
    assert all(rows[i].score == rows[240 + i].score for i in range(30))
    assert rows[len(texts) - 3].evidence and rows[len(texts) - 2].evidence == []


def test_held_out_recall_on_the_given_labels(spark):
    folder = "/root/testdata/sf0.1"
    if not Path(folder).exists():
        pytest.skip("no given tables")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = operator.scores(spark.read.parquet(f"{folder}/documents.parquet"), labels).where("held_out").select("doc_id", "predicted")
    truth = labels.groupBy("doc_id").agg({"toxic": "max"}).toDF("doc_id", "toxic").where("toxic IS NOT NULL")
    counts = {(r.toxic, r.predicted): r["count"] for r in found.join(truth, "doc_id").groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] >= 0.9 * (counts[1, 1] + counts.get((1, 0), 0))
    assert counts.get((0, 1), 0) <= 0.01 * (counts[0, 0] + counts.get((0, 1), 0))
    print(counts)
