"""Month bounds, slices and period selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.functions.labels import period_label, period_ordinal


def _over_all(value: Column) -> Column:
    """Over all rows; only used on distinct periods, one row per month of history."""
    return value.over(Window.partitionBy())


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    """First day of the month and of the next one."""
    following = (year + 1, 1) if month == 12 else (year, month + 1)
    return dt.date(year, month, 1), dt.date(*following, 1)


def month_slice(df: DataFrame, date_column: str, year: int, month: int) -> DataFrame:
    """Rows of one month, as a half-open range that reaches the Parquet scan."""
    first, following = month_bounds(year, month)
    return df.where((F.col(date_column) >= F.lit(first)) & (F.col(date_column) < F.lit(following)))


def period_catalog(df: DataFrame) -> DataFrame:
    """Distinct periods, newest first: ``year, month, label, is_default`` (the newest one)."""
    ordinal = period_ordinal()
    return (
        df.select("year", "month").distinct()
        .withColumns({
            "label": period_label(), "is_default": ordinal == _over_all(F.max(ordinal)),
        })
        .orderBy(F.desc("year"), F.desc("month"))
    )


def period_range(
    catalog: DataFrame,
    selected: Iterable[tuple[int, int]] = (),
    start: tuple[int, int] | None = None,
    end: tuple[int, int] | None = None,
) -> DataFrame:
    """Periods between two ends, ascending; empty when the end lies before the start.

    A missing end defaults to the first/last selected month if the catalog has it, else to the
    first/last month of the catalog.
    """
    chosen = sorted(year * 100 + month for year, month in selected)
    ordinal = period_ordinal()

    def bound(given, default, fallback):
        if given is not None:
            return F.lit(given[0] * 100 + given[1])
        known = _over_all(F.max(F.when(ordinal == F.lit(default), ordinal)))
        return F.coalesce(known, _over_all(fallback(ordinal)))

    return (
        catalog.select("year", "month").distinct()
        .withColumns({
            "_low": bound(start, chosen[0] if chosen else None, F.min),
            "_high": bound(end, chosen[-1] if chosen else None, F.max),
        })
        .where((ordinal >= F.col("_low")) & (ordinal <= F.col("_high")))
        .select("year", "month", period_label().alias("label"))
        .orderBy("year", "month")
    )


def resolve_period(catalog: DataFrame, run_date: dt.date, lag: int = 2, fallback: int = 1) -> DataFrame:
    """The period a run works on: ``lag`` months back if available, else up to ``fallback``
    months earlier. One row ``year, month, used_fallback``, or none."""
    target = run_date.year * 12 + run_date.month - 1 - lag
    serial = F.col("year") * 12 + F.col("month") - 1
    return (
        catalog.select("year", "month").distinct()
        .where(serial.between(target - fallback, target))
        .withColumn("used_fallback", serial < target)
        .orderBy(F.desc("year"), F.desc("month"))
        .limit(1)
    )
