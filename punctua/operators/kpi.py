"""Monthly KPI tables.

The fact is first reduced to additive statistics per (year, month, entity ids) and only then
joined with the dimensions: rows are combined map-side before the one shuffle, a hot entity
arrives as a handful of partial sums, and the joins see one row per entity and month. Dimension
keys are unique, so this equals joining first. Statistics of a fine grain roll up to any coarser
one, so one scan of the fact can feed all four tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.functions.rates import percent_2dp, ratio_2dp

# Fixed value: a flight is on time below this delay (strict).
ON_TIME_MINUTES = 15
CAUSES = ["carrier", "weather", "nas", "security", "late_aircraft"]
PERIOD = ["year", "month"]
AIRLINE_GRAIN = ["airline_id"]
ROUTE_GRAIN = ["origin_airport_id", "dest_airport_id"]
FLIGHT_GRAIN = ["airline_id", "flight_number", *ROUTE_GRAIN]


def _statistics() -> dict[str, Column]:
    dep, arr = F.col("dep_delay_minutes"), F.col("arr_delay_minutes")
    completed = (F.col("cancelled") == 0) & (F.col("diverted") == 0)
    return {
        "flights": F.count("*"),
        "completed": F.count_if(completed),
        "dep_on_time": F.count_if(completed & (dep < ON_TIME_MINUTES)),
        "arr_on_time": F.count_if(completed & (arr < ON_TIME_MINUTES)),
        "dep_n": F.count(dep),
        "dep_sum": F.sum(dep),
        "arr_n": F.count(arr),
        "arr_sum": F.sum(arr),
        "arr_completed_n": F.count(F.when(completed, arr)),
        "arr_completed_sum": F.sum(F.when(completed, arr)),
        "cancelled_n": F.count("cancelled"),
        "cancelled_sum": F.sum("cancelled"),
        "diverted_n": F.count("diverted"),
        "diverted_sum": F.sum("diverted"),
        **{f"{cause}_sum": F.sum(F.coalesce(F.col(f"{cause}_delay"), F.lit(0))) for cause in CAUSES},
    }


STATISTICS = [
    "flights", "completed", "dep_on_time", "arr_on_time", "dep_n", "dep_sum", "arr_n", "arr_sum",
    "arr_completed_n", "arr_completed_sum", "cancelled_n", "cancelled_sum", "diverted_n",
    "diverted_sum", *(f"{cause}_sum" for cause in CAUSES),
]


def flight_stats(fact: DataFrame, grain: list[str]) -> DataFrame:
    """Additive statistics of the fact per month and grain; unused ones are pruned by Catalyst."""
    return fact.groupBy(
        F.year("flight_date").alias("year"), F.month("flight_date").alias("month"), *grain
    ).agg(*[measure.alias(name) for name, measure in _statistics().items()])


def roll_up(stats: DataFrame, grain: list[str]) -> DataFrame:
    """Statistics of a finer grain added up to a coarser one."""
    return stats.groupBy(*PERIOD, *grain).agg(*[F.sum(s).alias(s) for s in STATISTICS])


def _common_measures() -> dict[str, Column]:
    return {
        "avg_dep_delay_minutes": ratio_2dp(F.col("dep_sum"), F.col("dep_n")),
        "avg_arr_delay_minutes": ratio_2dp(F.col("arr_sum"), F.col("arr_n")),
        "on_time_rate_pct": percent_2dp(F.col("arr_on_time"), F.col("flights")),
        "cancellation_rate_pct": percent_2dp(F.col("cancelled_sum"), F.col("cancelled_n")),
        "diversion_rate_pct": percent_2dp(F.col("diverted_sum"), F.col("diverted_n")),
        "dep_delay_flights": F.col("dep_n"),
        "dep_delay_sum_minutes": F.col("dep_sum"),
        "arr_delay_flights": F.col("arr_n"),
        "arr_delay_sum_minutes": F.col("arr_sum"),
    }


def airport_role(dim_airport: DataFrame, role: str) -> DataFrame:
    """The airport dimension in a role: every column prefixed with ``origin_`` or ``dest_``."""
    attributes = ["airport_id", "airport_code", "airport_name", "city", "state_code", "state"]
    return dim_airport.select(*[F.col(a).alias(f"{role}_{a}") for a in attributes])


def airline_kpi(stats: DataFrame, dim_airline: DataFrame) -> DataFrame:
    """Monthly KPI per airline from statistics at airline grain."""
    causes = {
        # Cause minutes are spread over all flights, not only over the delayed ones.
        f"avg_{cause}_delay_minutes": ratio_2dp(F.col(f"{cause}_sum"), F.col("flights"))
        for cause in CAUSES
    }
    return (
        stats.withColumns({**_common_measures(), **causes})
        .join(dim_airline, "airline_id")
        .select(*S.AIRLINE_KPI.names)
    )


def airport_kpi(stats: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Monthly KPI per airport and operation (DEP, ARR) from statistics at route grain.

    Each route row is handed to its two ends, so both operations come from one scan. Arrivals
    count completed flights only and have no cancellation or diversion rate.
    """
    no_sum = F.lit(None).cast("long")

    def end(operation: str, airport: str, flights: str, on_time: str, n: str, total: str, rates: bool):
        return F.struct(
            F.lit(operation).alias("operation"),
            F.col(airport).alias("airport_id"),
            F.col(flights).alias("flights"),
            F.col(on_time).alias("on_time"),
            F.col(n).alias("delay_flights"),
            F.col(total).alias("delay_sum_minutes"),
            *[
                (F.col(c) if rates else no_sum).alias(c)
                for c in ("cancelled_sum", "cancelled_n", "diverted_sum", "diverted_n")
            ],
        )

    ends = F.inline(F.array(
        end("DEP", "origin_airport_id", "flights", "dep_on_time", "dep_n", "dep_sum", True),
        end("ARR", "dest_airport_id", "completed", "arr_on_time", "arr_completed_n",
            "arr_completed_sum", False),
    ))
    additive = ["flights", "on_time", "delay_flights", "delay_sum_minutes",
                "cancelled_sum", "cancelled_n", "diverted_sum", "diverted_n"]
    return (
        stats.select(*PERIOD, ends)
        .groupBy(*PERIOD, "operation", "airport_id")
        .agg(*[F.sum(c).alias(c) for c in additive])
        .withColumns({
            "avg_delay_minutes": ratio_2dp(F.col("delay_sum_minutes"), F.col("delay_flights")),
            "on_time_rate_pct": percent_2dp(F.col("on_time"), F.col("flights")),
            "cancellation_rate_pct": percent_2dp(F.col("cancelled_sum"), F.col("cancelled_n")),
            "diversion_rate_pct": percent_2dp(F.col("diverted_sum"), F.col("diverted_n")),
        })
        .join(dim_airport, "airport_id")
        .select(*S.AIRPORT_KPI.names)
    )


def _with_route_airports(stats: DataFrame, dim_airport: DataFrame) -> DataFrame:
    for role in ("origin", "dest"):
        stats = stats.join(airport_role(dim_airport, role), f"{role}_airport_id")
    return stats


def route_kpi(stats: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Monthly KPI per route from statistics at route grain."""
    return _with_route_airports(stats.withColumns(_common_measures()), dim_airport).select(
        *S.ROUTE_KPI.names
    )


def flight_kpi(stats: DataFrame, dim_airline: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Monthly KPI per airline, flight number and route from statistics at that grain."""
    measured = stats.withColumns(_common_measures()).join(dim_airline, "airline_id")
    return _with_route_airports(measured, dim_airport).select(*S.FLIGHT_KPI.names)


def kpi_tables_from_stats(
    stats: DataFrame, dim_airline: DataFrame, dim_airport: DataFrame, routes: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All four KPI tables from statistics at flight grain, so the fact is scanned once. ``routes``
    takes a stored roll-up to route grain, which two of the tables read."""
    if routes is None:
        routes = roll_up(stats, ROUTE_GRAIN)
    return {
        "airlines": airline_kpi(roll_up(stats, AIRLINE_GRAIN), dim_airline),
        "airports": airport_kpi(routes, dim_airport),
        "routes": route_kpi(routes, dim_airport),
        "flights": flight_kpi(stats, dim_airline, dim_airport),
    }
