"""Duplicate removal and duplicate counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: list[str], order: list[str | Column] | None = None) -> DataFrame:
    """Keep the first row of each key; NULL keys count as equal.

    The order is completed by all remaining columns, so the survivor never depends on
    partitioning or retries. Catalyst turns ``row_number = 1`` into a group limit that also runs
    before the shuffle: of a hot key at most one row per task is shuffled.
    """
    given = list(order or [])
    named = {c for c in given if isinstance(c, str)}
    rest = [c for c in df.columns if c not in named and c not in keys]
    window = Window.partitionBy(*keys).orderBy(*(given + rest or [F.lit(1)]))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys (all parts non-NULL) that occur more than once, with their row count."""
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return df.where(known).groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")
