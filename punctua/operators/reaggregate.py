"""Re-aggregation of monthly KPI rows over any set of months, totals, thresholds, selections.

Delay averages combine exactly from their (sum, count) columns. Percentages are flight-weighted
means of the stored monthly values, which have two decimals: weighting them as whole hundredths
keeps sums exact and independent of task order. Values without a fixed number of decimals
(``scale=None``) are weighted as doubles and added up as decimals, for the same reason.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.functions.labels import route_label
from punctua.schemas import DELAY_PARTS

STORED_DECIMALS = 2


def _zero_if_null(total: Column) -> Column:
    return F.coalesce(total, F.lit(0).cast("long"))


def _parts(df: DataFrame, column: str) -> tuple[str, str] | None:
    parts = DELAY_PARTS.get(column)
    return parts if parts and set(parts) <= set(df.columns) else None


def _decimal_sum(value: Column) -> Column:
    """Sum of doubles in millionths: unlike a double sum it does not depend on task order."""
    return F.sum(value.cast("decimal(38,6)"))


def _weighted(column: str, scale: int | None) -> tuple[Column, Column]:
    """(numerator, denominator) aggregates of a flight-weighted mean that skips NULL values."""
    value, weight = F.col(column), F.col("flights")
    weights = F.sum(F.when(value.isNotNull(), weight))
    if scale is None:
        return _decimal_sum(value * weight), weights
    units = F.round(value * 10**scale).cast("long")
    return F.sum(units * weight), weights * F.lit(10**scale)


def _quotient(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL for a zero or missing denominator."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0).cast("long")).cast("double")


def aggregate_periods(
    df: DataFrame, group_columns: list[str], weighted_columns: list[str],
    scale: int | None = STORED_DECIMALS,
) -> DataFrame:
    """Combine monthly KPI rows per group; NULL group keys form a group.

    Output: group columns, ``flights``, the delay (sum, count) columns, then the combined KPI
    columns. A KPI without any weight is NULL.
    """
    sums = {"flights": _zero_if_null(F.sum("flights"))}
    finals = {}
    for column in weighted_columns:
        parts = _parts(df, column)
        if parts:
            sums |= {p: _zero_if_null(F.sum(p)) for p in parts}
            finals[column] = _quotient(F.col(parts[0]), F.col(parts[1]))
        else:
            numerator, denominator = _weighted(column, scale)
            sums |= {f"_{column}_num": numerator, f"_{column}_den": denominator}
            finals[column] = _quotient(F.col(f"_{column}_num"), F.col(f"_{column}_den"))
    grouped = df.groupBy(*group_columns).agg(*[a.alias(name) for name, a in sums.items()])
    kept = [name for name in sums if not name.startswith("_")]
    return grouped.select(*group_columns, *kept, *[c.alias(name) for name, c in finals.items()])


def _weighted_average(df: DataFrame, column: str, scale: int | None) -> Column:
    parts = _parts(df, column)
    if parts:
        total, count = (_zero_if_null(F.sum(p)) for p in parts)
        return F.coalesce(_quotient(total, count), F.lit(0.0))
    return _quotient(*_weighted(column, scale))


def weighted_average(df: DataFrame, columns: Iterable[str], scale: int | None = STORED_DECIMALS) -> DataFrame:
    """One row with the overall value of each column: 0 for a delay without flights, NULL for a
    rate without flights."""
    return df.agg(*[_weighted_average(df, c, scale).alias(c) for c in columns])


def total_row(
    df: DataFrame, labels: dict[str, str | None], weighted_columns: list[str], null_weight: str = "skip"
) -> DataFrame:
    """The grand total of entity rows as one row, labelled by ``labels``.

    ``null_weight="skip"`` leaves rows with a NULL value out of the weights (airlines);
    ``"keep"`` divides by all flights, so an all-NULL rate totals 0 (airports, routes).
    Entity values are already combined, hence not limited to two decimals.
    """
    if null_weight not in ("skip", "keep"):
        raise ValueError(f"null_weight must be 'skip' or 'keep', not {null_weight!r}")
    flights = _zero_if_null(F.sum("flights"))
    totals = {"flights": flights}
    for column in weighted_columns:
        for part in _parts(df, column) or ():
            totals[part] = _zero_if_null(F.sum(part))
    for column in weighted_columns:
        if null_weight == "skip" or _parts(df, column):
            totals[column] = _weighted_average(df, column, None)
        else:
            weighted = _decimal_sum(F.col(column) * F.col("flights"))
            totals[column] = F.coalesce(_quotient(weighted, flights), F.lit(0.0))
    types = {f.name: f.dataType for f in df.schema.fields}
    total = df.agg(*[a.alias(name) for name, a in totals.items()])
    return total.select(
        *[F.lit(value).cast(types.get(name, "string")).alias(name) for name, value in labels.items()],
        *totals,
    )


def with_total(
    df: DataFrame, labels: dict[str, str | None], weighted_columns: list[str], null_weight: str = "skip"
) -> DataFrame:
    """Entity rows plus their total row, told apart by ``is_total`` (sort on it to place it).

    ``df`` is evaluated twice; stage it when it is costly.
    """
    total = total_row(df, labels, weighted_columns, null_weight).withColumn("is_total", F.lit(True))
    return df.withColumn("is_total", F.lit(False)).unionByName(total, allowMissingColumns=True)


def min_share(df: DataFrame, share: float) -> DataFrame:
    """Entities with more than this share of all flights (strict).

    ``df`` is evaluated twice; stage it when it is costly.
    """
    least = df.agg(F.sum("flights") * F.lit(share)).scalar()
    return df.where(F.col("flights") > least)


def min_volume(df: DataFrame, flights_per_month: int, months: int) -> DataFrame:
    """Entities with more than ``flights_per_month`` flights in each month on average (strict)."""
    return df.where(F.col("flights") > flights_per_month * months)


def select_entities(df: DataFrame, column: str, wanted: Iterable | DataFrame) -> DataFrame:
    """Rows of the wanted entities: a short list becomes a filter, a frame a semi join."""
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select(F.col(wanted.columns[0]).alias(column)), column, "left_semi")
    return df.where(F.col(column).isin(list(wanted)))


def route_pick(routes: DataFrame, origin: str | None = None, dest: str | None = None) -> DataFrame:
    """Routes from and/or to an airport code; None leaves that end open."""
    if origin is not None:
        routes = routes.where(F.col("origin_airport_code") == origin)
    if dest is not None:
        routes = routes.where(F.col("dest_airport_code") == dest)
    return routes


def operation_rows(airports: DataFrame, operation: str) -> DataFrame:
    return airports.where(F.col("operation") == operation)


def entity_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: ``row_count`` and the number of distinct non-NULL values of each column."""
    return df.agg(
        F.count("*").alias("row_count"),
        *[F.count_distinct(F.col(c)).alias(f"{c}_count") for c in columns],
    )


FLIGHT_GROUP = [
    "airline_id", "airline_name", "airline_code", "flight_number",
    "origin_airport_id", "origin_airport_code", "origin_city", "origin_state_code", "origin_state",
    "dest_airport_id", "dest_airport_code", "dest_city", "dest_state_code", "dest_state",
]
ROUTE_MEASURES = [
    "avg_dep_delay_minutes", "avg_arr_delay_minutes", "on_time_rate_pct",
    "cancellation_rate_pct", "diversion_rate_pct",
]


def flight_number_rows(monthly: DataFrame, airline: str | None = None) -> DataFrame:
    """Combined flight-number rows with their route label, of one airline or of all."""
    if airline is not None:
        monthly = monthly.where(F.col("airline_name") == airline)
    combined = aggregate_periods(monthly, FLIGHT_GROUP, ROUTE_MEASURES)
    return combined.withColumn("route", route_label())


def flight_number_view(monthly: DataFrame, airline: str | None = None) -> DataFrame:
    """Headline figures per airline: distinct flight numbers, flights, overall on-time rate.

    The rate's numerator skips NULL rates while its denominator counts all flights.
    """
    rows = flight_number_rows(monthly, airline).where(F.col("airline_name").isNotNull())
    return rows.groupBy("airline_name").agg(
        F.count_distinct("flight_number").alias("flight_numbers"),
        _zero_if_null(F.sum("flights")).alias("flights"),
        F.coalesce(
            _quotient(_decimal_sum(F.col("on_time_rate_pct") * F.col("flights")), F.sum("flights")),
            F.lit(0.0),
        ).alias("overall_on_time_rate"),
    )
