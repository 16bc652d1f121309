"""A training-data pipeline over ``documents``: from raw rows to packed token sequences.

Each stage takes the rows its predecessor kept and returns the rows it keeps, in the columns of
``documents``; the last returns the packed pieces. Stages find their rows again by id and a hash of
the text, so any other columns pass through, whatever their names; rows equal in both are one
document that occurs several times.

Defined results: see the operators in ``punctua.llm``; an empty table passes through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from punctua.llm.common import join_on, table
from punctua.sources.storage import staged

KEY = ["doc_id", "raw"]
# Near copies of a training corpus share four fifths of their shingles of five words.
NEAR_PERCENT = 80
# Mixing, packing and the similarity search are randomised or sequential: no SQL counterpart.
ORACLE_SQL = None


def _tagged(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("raw"))


def _repeated(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Every row of ``docs`` as often as ``decided`` (``doc_id, raw, copies``, one row per row of
    ``docs``) says; equal rows share their copies."""
    facts = staged(decided.groupBy(*KEY).agg(F.sum("copies").cast("int").alias("copies"), F.count("*").alias("n")), "decided")
    tagged = _tagged(docs)
    kept = join_on(tagged, facts.where("n > 1 OR copies <> 1").select(*KEY), KEY, "left_anti").select("row")
    several = facts.where("copies > 1 OR n > 1 AND copies > 0")
    if not several.isEmpty():
        once = join_on(tagged, several.select(*KEY, "copies"), KEY).dropDuplicates(KEY)
        kept = kept.union(once.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row"))
    return kept.select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.scores(docs, table(spark, sf_dir, "labels"))
    return join_on(_tagged(docs), scored.where("predicted = 1").select(*KEY).distinct(), KEY, "left_anti").select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(docs)
    return _repeated(docs, groups.select(*KEY, F.expr("int(uid = keep_uid)").alias("copies")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = near_dedup.near_groups(docs, percent=NEAR_PERCENT)
    return _repeated(docs, groups.select(*KEY, F.expr("int(uid = keep_uid)").alias("copies")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _repeated(docs, mixing.mix(docs, table(spark, sf_dir, "labels")).select(*KEY, "copies"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of all documents that the stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
