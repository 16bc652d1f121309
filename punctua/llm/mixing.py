"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources share the words of the whole corpus by weight, each at most ``LIMIT`` times its own size;
what a capped source leaves is shared again by weight. A source with a target above its size gives
all its documents for every complete epoch. The fraction that remains is filled by weighted sampling
without replacement: documents are ordered by an exponential key divided by their quality weight and
taken while the running sum of their sizes stays nearest to the rest of the target.

Defined results: a null text has no words; a null source is a source of its own, ordered last; a
document without words takes none; keys depend on ``doc_id`` only, ties go by ``doc_id`` and size, so
reruns agree; quality labels that are missing weigh 1, repeated ones count by their largest; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm.common import WORD, join_on, running_sum, staged_rows
from punctua.sources.storage import staged

LIMIT = 3
WEIGHTS = (1, 2, 3)
QUALITY_WEIGHT = {1: 2.0, 0: 0.5}
HASH_BITS = 48


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) that depends on the id only."""
    head = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return (F.conv(head, 16, 10).cast("long") + 0.5) / F.lit(float(2**HASH_BITS))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from rows with ``source, size``.

    The level is raised until no source with a share below its limit exceeds it; only sums reach
    the driver. Each pass settles at least one source, in practice most of them at once.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumns(
        {"_all": F.lit(0), "_one": F.lit(1)})
    placed = running_sum(totals, "_all", ["source"], "_one", "place")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("place") - 1) % len(WEIGHTS) + 1).cast("int"))
    weighted = staged(placed.select("source", "source_size", weight.alias("weight")), "sources")
    most = LIMIT * F.col("source_size")

    def sums(level: float):
        free = most > F.lit(level) * F.col("weight")
        return weighted.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(~free, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0)),
        ).first()

    level = -1.0
    while True:
        total, capped, free = sums(level)
        raised = (total - capped) / free if free else level
        if raised <= level:
            break
        level = raised
    target = F.when(most > F.lit(level) * F.col("weight"), F.lit(level) * F.col("weight"))
    return weighted.select("source", "source_size", target.otherwise(most.cast("double")).alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """Per document ``doc_id, raw, source, size, source_size, target, copies, taken``.

    ``copies`` is how often the mix takes the document, ``taken`` the words that gives, ``raw`` a
    hash of the text. ``quality`` has ``doc_id, quality``; see ``QUALITY_WEIGHT``.
    """
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("raw"),
    )
    weight = F.lit(1.0)
    if quality is not None:
        known = quality.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("_quality"))
        measured = measured.join(known, "doc_id", "left")
        for label, value in QUALITY_WEIGHT.items():
            weight = F.when(F.col("_quality") == label, F.lit(value)).otherwise(weight)
    rows = staged_rows(
        measured.select("doc_id", "source", "size", "raw", (-F.ln(uniform(F.col("doc_id"))) / weight).alias("key")),
        "sizes",
    )
    targets = staged(source_targets(rows), "targets")
    summed = running_sum(rows, "source", ["key", "doc_id", "size", "raw"], "size", "sum")
    joined = join_on(summed, targets, ["source"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    # The middle of the document lies below the rest: taking it brings the sum no further away.
    chosen = (F.col("size") > 0) & (2 * F.col("sum") - F.col("size") <= 2 * F.col("rest"))
    return (
        joined.withColumn("epochs", epochs).withColumn("rest", rest)
        .withColumn("copies", (F.col("epochs") + chosen.cast("long")).cast("int"))
        .select("doc_id", "raw", "source", "size", "source_size", "target", "copies",
                (F.col("size") * F.col("copies")).alias("taken"))
    )
