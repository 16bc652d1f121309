"""Every stage against a plain version of it, on documents with copies, toxic texts and odd rows."""

import random
import re

import corpora
import corpus_pipeline
import pytest
from punctua.llm import registry


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(24)
    texts, toxic = corpora.odd_texts(rng), []
    toxic += [0] * len(texts)
    for i in range(500):
        words = corpora.prose(rng, rng.randint(20, 90)).split()
        if i % 6 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zorkel", "blimfar"]))
        texts.append(" ".join(words))
        toxic.append(int(i % 6 == 0))
    clean = [t for t, bad in zip(texts, toxic) if t and not bad and 40 < len(t.split()) < 100]
    copies = [clean[0]] * 30 + [clean[1] + " "] * 3
    for text in clean[2:12]:
        copies += corpora.near_copies(rng, text + " " + corpora.prose(rng, 100), 4, 1)
    texts, toxic = texts + copies, toxic + [0] * len(copies)
    path = str(tmp_path_factory.mktemp("sf"))
    corpora.frame(spark, texts, [rng.choice(["a", "b", None]) for _ in texts]).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, texts, toxic


def test_stages_one_after_another(spark, folder, tmp_path):
    path, texts, toxic = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    ids = list(range(len(texts)))
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if name == "packing":
            break
        assert docs.columns == columns and docs.where("row <> 'r' OR raw <> 'x'").isEmpty()
        found = [r.doc_id for r in docs.select("doc_id").collect()]
        if name == "toxicity":
            assert sorted(found) == [i for i in ids if not toxic[i]]
        if name == "exact dedup":
            groups = {}
            for i in ids:
                groups.setdefault(re.sub("[\x20\x09-\x0D]", "", texts[i] or ""), []).append((-len(texts[i] or ""), i))
            assert sorted(found) == sorted(min(g)[1] for g in groups.values())
        if name == "near dedup":
            sets = []
            for i in ids:
                words = (texts[i] or "").lower().split()
                sets.append({tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
            linked = [(a, b) for a in range(len(ids)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
            groups = corpora.components(len(ids), linked)
            assert sorted(found) == [ids[i] for i in range(len(ids)) if groups[i] == i] and len(linked) > 20
        if name == "mixing":
            assert set(found) <= set(ids) and max(map(found.count, set(found))) <= 3
        ids = sorted(found)
    pieces = docs.collect()
    assert sorted(r.doc_id for r in pieces if r.piece == 0) == ids
    assert all(r.offset + r.length <= 2048 for r in pieces)


def test_near_copies_from_four_fifths_on_are_dropped(spark):
    rng = random.Random(25)
    texts = []
    for _ in range(60):
        words = corpora.prose(rng, rng.randint(40, 70)).split()
        texts += [" ".join(words), " ".join(words[:20] + ["edited"] + words[21:])]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    shares = {(a, b): 100 * len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in range(len(texts)) for b in range(a)}
    groups = corpora.components(len(texts), [pair for pair, share in shares.items() if share >= 80])
    assert sum(80 <= share < 85 for share in shares.values()) > 10
    kept = corpus_pipeline.drop_near_copies(spark, corpora.frame(spark, texts), "").collect()
    assert sorted(r.doc_id for r in kept) == [i for i in range(len(texts)) if groups[i] == i]


def test_equal_rows_are_one_document_that_occurs_several_times(spark):
    docs = corpora.frame(spark, ["a", "a", "b", "c"], ids=[1, 1, 2, None])
    decided = docs.selectExpr("doc_id", "xxhash64(text) AS raw", "CASE text WHEN 'a' THEN 2 WHEN 'b' THEN 0 ELSE 1 END AS copies")
    assert sorted(r.text for r in corpus_pipeline._repeated(docs, decided).collect()) == ["a"] * 4 + ["c"]


def test_run_on_empty_tables(spark, tmp_path):
    corpora.frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.ORACLES) <= set(registry.QUERIES)
