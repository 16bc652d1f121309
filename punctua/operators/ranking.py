"""Sorting, top-n and placing total rows. Every order ends with the ids, so it is total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.sources.tables import with_positions

# The orders in which entities can be listed.
SORT_MODES = {
    "airport_city": ["+city", "+airport_code"],
    "airport_flights": ["-flights", "+city", "+airport_code"],
    "airport_code": ["+airport_code"],
    "airport_state": ["+state", "+city", "+airport_code"],
    "route_flights": ["-flights", "+origin_airport_code", "+dest_airport_code"],
    "route_alphabetical": [
        "+origin_city", "+origin_airport_code", "+dest_city", "+dest_airport_code",
    ],
}
IDS = {"airport": ["airport_id"], "route": ["origin_airport_id", "dest_airport_id"]}


def _nulls_last(columns: list[Column], kind: str) -> Column:
    return F.array(*[F.struct(c.isNull().alias("unknown"), c.cast(kind).alias("value")) for c in columns]) if columns \
        else F.array().cast(f"array<struct<unknown: boolean, value: {kind}>>")


def order_key(numbers: list[Column], texts: list[Column], ids: list[Column], slot: int = 0) -> Column:
    """One sortable value: slot, numbers (negate them to descend), texts, ids; unknown ones last.

    Rows of differently sorted listings have values of the same type, so that all listings can be
    numbered in one go.
    """
    return F.struct(
        F.lit(slot).alias("slot"), _nulls_last(numbers, "double").alias("numbers"),
        _nulls_last(texts, "string").alias("texts"), _nulls_last(ids, "long").alias("ids"),
    )


def sort_key(mode: str) -> Column:
    columns = SORT_MODES[mode]
    return order_key(
        [-F.col(c[1:]) for c in columns if c[0] == "-"], [F.col(c[1:]) for c in columns if c[0] == "+"],
        [F.col(c) for c in IDS[mode.split("_")[0]]],
    )


def top_n(df: DataFrame, metric: str, n: int, tie_break: list[str]) -> DataFrame:
    """The n rows with the highest metric, with their ``position``; NULL metrics come last.

    The sort keeps n rows per task and never shuffles the rest; the window sees n rows.
    """
    order = [F.desc_nulls_last(metric), *[F.asc_nulls_last(c) for c in tie_break]]
    top = df.orderBy(*order).limit(n)
    return top.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def number_listings(rows: DataFrame, listing: str) -> DataFrame:
    """``position`` in every listing of rows that carry its name and their ``order`` in it."""
    return with_positions(rows, listing, [F.col("order")], "position").drop("order")


def entity_sort(df: DataFrame, mode: str) -> DataFrame:
    """All rows with their 1-based ``position`` in one of the listing orders."""
    return number_listings(df.withColumns({"order": sort_key(mode), "_mode": F.lit(mode)}), "_mode").drop("_mode")


def placed_rows(
    entities: DataFrame, total: DataFrame, metric: str, name: str, placement: str,
    sort_by: str = "metric", ids: list[str] | None = None,
) -> DataFrame:
    """Entities with their ``order`` by metric or name, and the total row placed among them.

    ``placement``: ``first``, ``ranked`` (among the entities by its own value), ``both_ends`` or
    ``omitted``. ``ids`` tell entities of the same name apart.
    """
    if placement not in ("first", "ranked", "both_ends", "omitted"):
        raise ValueError(f"unknown placement {placement!r}")
    known = [F.col(c) for c in ids or []]

    def ordered(df: DataFrame, slot: int) -> DataFrame:
        missing = {c: F.lit(None).cast("long") for c in ids or [] if c not in df.columns}
        numbers = [-F.col(metric)] if sort_by != "name" else []
        return df.withColumns(missing).withColumn("order", order_key(numbers, [F.col(name)], known, slot))

    rows = ordered(entities, 1)
    for slot in {"first": [0], "ranked": [1], "both_ends": [0, 2], "omitted": []}[placement]:
        rows = rows.unionByName(ordered(total, slot), allowMissingColumns=True)
    return rows


def rank_with_total(
    entities: DataFrame, total: DataFrame, metric: str, name: str, placement: str,
    sort_by: str = "metric", ids: list[str] | None = None,
) -> DataFrame:
    """``placed_rows`` with their ``position``."""
    rows = placed_rows(entities, total, metric, name, placement, sort_by, ids)
    return number_listings(rows.withColumn("_listing", F.lit(0)), "_listing").drop("_listing")
