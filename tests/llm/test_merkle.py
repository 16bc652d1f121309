import random
import zlib

import duckdb
import pytest
from compare import differences
from corpora import DOCUMENTS, odd_texts, sha
from pyspark.sql import functions as F
from punctua.llm import merkle
from punctua.llm.oracles import MERKLE
from punctua.sources.storage import Scratch


def encoded(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes: list[str], arity: int):
    """The root of some digests, and the steps ``(before, after)`` of each of them."""
    steps = [[] for _ in nodes]
    level, places = nodes, list(range(len(nodes)))
    while len(level) > 1:
        for i, place in enumerate(places):
            run = place - place % arity
            steps[i].append(("".join(level[run:place]), "".join(level[place + 1:run + arity])))
        level = [sha("".join(level[at:at + arity])) for at in range(0, len(level), arity)]
        places = [place // arity for place in places]
    return level[0], steps


def brute_force(rows, arity=2):
    """Per row ``(leaf, subroot, root, steps)``, in the given order of ``rows`` = ``(doc_id, source, lang, n_chars, text)``."""
    leaves = [sha("".join(map(encoded, row))) for row in rows]
    trees: dict = {}
    for at in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0], leaves[i])):
        trees.setdefault(rows[at][2], []).append(at)
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    grown = {lang: climb([leaves[at] for at in trees[lang]], arity) for lang in names}
    root, above = climb([grown[lang][0] for lang in names], arity)
    out: list = [None] * len(rows)
    for lang, more in zip(names, above):
        for at, steps in zip(trees[lang], grown[lang][1]):
            out[at] = (leaves[at], grown[lang][0], root, steps + more)
    return out


def documents(spark, rows):
    """A documents table of ``(doc_id, source, lang, n_chars, text)`` with clashing extra columns."""
    extra = "tree string, place long, width long, digest string, path string, level int, range int, rank int, uid long"
    return spark.createDataFrame(
        [(*row, "t", 5, 6, "d", "p", 1, 2, 3, 4) for row in rows],
        f"doc_id long, source string, lang string, n_chars long, text string, {extra}")


def sample(count: int) -> list[tuple]:
    rng = random.Random(count)
    texts = odd_texts(rng)
    return [
        (rng.choice([None, i, i, i, 7]), rng.choice([None, "", "web", "é"]), rng.choice(["en", "en", None, "", "fr", "é\U0001F600", "zz"]),
         rng.choice([None, 0, i, -3]), texts[i % len(texts)])
        for i in range(count)
    ]


@pytest.mark.parametrize("count", [1, 2, 3, 150])
def test_matches_sql_and_brute_force(spark, count):
    rows = sample(count)
    docs = documents(spark, rows)
    result = merkle.audit(docs)
    wanted = []
    for row, (leaf, subroot, root, steps) in zip(rows, brute_force(rows)):
        digest = leaf
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
            digest = sha("".join(map(encoded, (*row[:3], row[3] + 1, row[4]))))
        for before, after in steps:
            digest = sha(before + digest + after)
        wanted.append((row[0], leaf, subroot, root, sha("".join(a + b for a, b in steps)), digest, digest == root))
    found = [tuple(row) for row in result.collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    duck = duckdb.connect()
    duck.register("documents", docs.select("doc_id", "source", "lang", "n_chars", "text").toArrow())
    assert differences(result, duck, MERKLE) == []


@pytest.mark.parametrize("arity", [3, 5])
def test_other_arities(spark, arity):
    rows = [(i, "s", "en" if i % 3 else "fr", i, f"text {i}") for i in range(100)]
    with Scratch(spark) as scratch:
        found = {row.doc_id: row for row in merkle.manifest(documents(spark, rows), scratch, arity=arity).withColumn(
            "folded", merkle.folded(F.col("leaf"), F.col("path"))).collect()}
    for row, (leaf, subroot, root, steps) in zip(rows, brute_force(rows, arity)):
        got = found[row[0]]
        assert (got.leaf, got.subroot, got.root, got.folded) == (leaf, subroot, root, root)
        assert [(step.before, step.after) for step in got.path] == steps


def test_a_hot_group_is_placed_by_many_tasks(spark):
    docs = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, "en").otherwise("").alias("tree"), F.struct("id").alias("rank"), F.lit("d").alias("digest"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = docs.repartitionByRange("tree", "rank").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        with Scratch(spark) as scratch:
            hot = merkle.placed(docs, scratch).where("tree = 'en'").agg(
                F.count_distinct("place"), F.min("place"), F.max("place"), F.min("width"), F.max("width")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tuple(hot) == (26_666, 0, 26_665, 26_666, 26_666)
    assert sizes < 10_000


def test_empty_table(spark):
    assert merkle.audit(spark.createDataFrame([], DOCUMENTS)).count() == 0
