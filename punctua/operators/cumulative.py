"""Any range of months from two rows per entity.

A snapshot holds, for one month and every entity seen until then, the running sums of all its monthly
KPI rows so far. The figures of a range are the snapshot of its last month minus that of the month
before its first, so a range of any length reads two months, and equals
``reaggregate.aggregate_periods`` over its rows exactly: all sums are whole numbers.

A new month extends the last snapshot by one aggregation (``extend``); the whole history is built with
one window per entity, which holds one row per month (``snapshots``). Snapshots are stored by month,
so that the two of a range are partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.operators.reaggregate import STORED_DECIMALS, _parts, _quotient

PERIOD = ["year", "month"]
ROWS = "months"  # monthly rows behind the sums


def serial(year="year", month="month") -> Column:
    """Months as consecutive numbers."""
    return F.col(year) * 12 + F.col(month) - 1


def _dated(number: Column) -> dict[str, Column]:
    return {"year": F.floor(number / 12).cast("int"), "month": (number % 12 + 1).cast("int")}


def _sum_names(df: DataFrame, weighted_columns: list[str]) -> list[str]:
    names = [ROWS, "flights"]
    for column in weighted_columns:
        names += _parts(df, column) or (f"{column}_units", f"{column}_weight")
    return list(dict.fromkeys(names))


def _row_sums(df: DataFrame, weighted_columns: list[str]) -> dict[str, Column]:
    """What one monthly row adds to the sums; NULL adds nothing."""
    def known(value: Column) -> Column:
        return F.coalesce(value.cast("long"), F.lit(0).cast("long"))

    sums = {ROWS: F.lit(1).cast("long"), "flights": known(F.col("flights"))}
    for column in weighted_columns:
        parts = _parts(df, column)
        if parts:
            sums |= {part: known(F.col(part)) for part in parts}
        else:
            units = F.round(F.col(column) * 10**STORED_DECIMALS).cast("long")
            sums[f"{column}_units"] = known(units * F.col("flights"))
            sums[f"{column}_weight"] = known(F.when(F.col(column).isNotNull(), F.col("flights")))
    return sums


def snapshots(monthly: DataFrame, group_columns: list[str], weighted_columns: list[str]) -> DataFrame:
    """Snapshots of every month from the first to the last of ``monthly``: ``year, month``, the group
    columns (NULL keys form a group), ``months``, ``flights`` and the other sums.

    An entity is in all snapshots from its first month on, also in months it has no rows for.
    """
    names = _sum_names(monthly, weighted_columns)
    rows = monthly.select(serial().alias("_at"), *group_columns, *[c.alias(n) for n, c in _row_sums(monthly, weighted_columns).items()])
    per_month = rows.groupBy("_at", *group_columns).agg(*[F.sum(n).alias(n) for n in names])
    last = monthly.agg(F.max(serial())).scalar()
    history = Window.partitionBy(*group_columns).orderBy("_at")
    running = per_month.select(
        "_at", *group_columns,
        *[F.sum(n).over(history.rowsBetween(Window.unboundedPreceding, 0)).alias(n) for n in names],
        F.lead("_at").over(history).alias("_next"))
    months = F.explode(F.sequence("_at", F.coalesce(F.col("_next") - 1, last)))
    filled = running.withColumn("_month", months)
    return filled.select(*[c.alias(n) for n, c in _dated(F.col("_month")).items()], *group_columns, *names)


def extend(
    last: DataFrame, monthly: DataFrame, period: tuple[int, int], group_columns: list[str], weighted_columns: list[str],
) -> DataFrame:
    """The snapshot of ``period`` from that of the month before and the monthly rows of ``period``."""
    names = _sum_names(monthly, weighted_columns)
    new = monthly.where((F.col("year") == period[0]) & (F.col("month") == period[1])).select(
        *group_columns, *[c.alias(n) for n, c in _row_sums(monthly, weighted_columns).items()])
    summed = last.select(*group_columns, *names).unionByName(new).groupBy(*group_columns).agg(*[F.sum(n).alias(n) for n in names])
    return summed.select(F.lit(period[0]).alias("year"), F.lit(period[1]).alias("month"), *group_columns, *names)


def _finals(differences: DataFrame, keys: list[str], weighted_columns: list[str]) -> DataFrame:
    kept, finals = ["flights"], []
    for column in weighted_columns:
        parts = _parts(differences, column)
        if parts:
            kept += parts
            finals.append(_quotient(F.col(parts[0]), F.col(parts[1])).alias(column))
        else:
            weight = F.col(f"{column}_weight") * F.lit(10**STORED_DECIMALS)
            finals.append(_quotient(F.col(f"{column}_units"), weight).alias(column))
    return differences.where(F.col(ROWS) > 0).select(*keys, *dict.fromkeys(kept), *finals)


def range_kpi(
    stored: DataFrame, first: tuple[int, int], last: tuple[int, int], group_columns: list[str], weighted_columns: list[str],
) -> DataFrame:
    """``aggregate_periods`` of the months from ``first`` to ``last``, read from two snapshots.

    ``last`` must be a stored month; ``first`` may lie before the history. A range that ends before
    it begins is empty.
    """
    names = _sum_names(stored, weighted_columns)
    before, end = first[0] * 12 + first[1] - 2, last[0] * 12 + last[1] - 1
    if end <= before:
        return _finals(stored.where("false"), group_columns, weighted_columns)
    either = [(F.col("year") == number // 12) & (F.col("month") == number % 12 + 1) for number in (before, end)]
    picked = stored.where(either[0] | either[1])
    sign = F.when(serial() == end, F.lit(1)).otherwise(F.lit(-1))
    differences = picked.groupBy(*group_columns).agg(*[F.sum(sign * F.col(n)).alias(n) for n in names])
    return _finals(differences, group_columns, weighted_columns)


def _histories(stored: DataFrame, group_columns: list[str], names: list[str]) -> DataFrame:
    """One row per entity: the month ``_low`` of its first snapshot, and in ``_sums`` its snapshots from
    there on, one place per month (NULL for a month without one). The only shuffle of the snapshots."""
    # A number of its own: adaptive execution would merge the rows, small before they meet the ranges.
    parts = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored.withColumn("_at", serial()).where("_at IS NOT NULL").repartition(parts, *group_columns)
    per_month = rows.groupBy(*group_columns, "_at").agg(*[F.sum(n).alias(n) for n in names])
    listed = per_month.groupBy(*group_columns).agg(
        F.array_sort(F.collect_list(F.struct("_at", *names))).alias("_rows"), F.min("_at").alias("_low"), F.max("_at").alias("_high"))
    placed = F.transform(F.sequence("_low", "_high"), lambda at: F.get(F.filter("_rows", lambda row: row["_at"] == at), F.lit(0)))
    whole = F.size("_rows") == F.col("_high") - F.col("_low") + 1
    return listed.select(*group_columns, "_low", F.when(whole, F.col("_rows")).otherwise(placed).alias("_sums"))


def ranges_kpi(stored: DataFrame, ranges: DataFrame, group_columns: list[str], weighted_columns: list[str]) -> DataFrame:
    """Many ranges at once: ``range_id``, the group columns and the figures of ``aggregate_periods``.

    ``ranges`` holds ``range_id, first, last``, the ends as serial months; ranges of one ``range_id`` are
    added up. Every entity has a figure for nearly every range, so the ranges come to the entities: an
    entity's snapshots lie in one row, which holds both ends of any range, and what is shuffled are the
    snapshots, however many ranges there are.
    """
    names = _sum_names(stored, weighted_columns)
    wanted = ranges.where("first <= last").select("range_id", F.col("first").alias("_first"), F.col("last").alias("_last"))
    met = _histories(stored, group_columns, names).crossJoin(wanted).select(
        "range_id", *group_columns, F.get("_sums", (F.col("_last") - F.col("_low")).cast("int")).alias("_end"),
        F.get("_sums", (F.col("_first") - 1 - F.col("_low")).cast("int")).alias("_before"))

    def sum_at(end: str, name: str) -> Column:
        return F.coalesce(F.col(end)[name], F.lit(0).cast("long"))

    differences = met.select("range_id", *group_columns, *[(sum_at("_end", n) - sum_at("_before", n)).alias(n) for n in names])
    if not wanted.groupBy("range_id").count().where("count > 1").isEmpty():
        differences = differences.groupBy("range_id", *group_columns).agg(*[F.sum(n).alias(n) for n in names])
    return _finals(differences, ["range_id", *group_columns], weighted_columns)


def all_ranges(periods: DataFrame) -> DataFrame:
    """Every range of months between the first and the last of ``periods``, as ``ranges_kpi`` takes them;
    ``range_id`` reads ``first * 100000 + last``."""
    known = periods.agg(F.min(serial()).alias("low"), F.max(serial()).alias("high")).where("low IS NOT NULL")
    starts = known.select(F.explode(F.sequence("low", "high")).alias("first"), "high")
    return starts.select("first", F.explode(F.sequence("first", "high")).alias("last")).select(
        (F.col("first").cast("long") * 100000 + F.col("last")).alias("range_id"), "first", "last")
