"""Cleaned tables to star schema, KPI tables and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.operators import quality
from punctua.operators.kpi import (
    FLIGHT_GRAIN, ROUTE_GRAIN, flight_stats, kpi_tables_from_stats, roll_up,
)
from punctua.operators.star import build_dim_airline, build_dim_airport, build_fact
from punctua.sources.concurrent import together
from punctua.plans.silver import FLIGHTS
from punctua.plans.steps import Steps
from punctua.session import tune
from punctua.sources.releases import read_months, release
from punctua.sources.storage import Scratch
from punctua.sources.tables import (
    ensure_table, evolve, merge_snapshot, read_snapshot, replace_period, scan_period, with_period_key,
    write_periods,
)

FACT, DIM_AIRLINE, DIM_AIRPORT = "star/fact_flight", "star/dim_airline", "star/dim_airport"
GOLD = "gold"
CHECKS, PRESENCE = "quality/checks", "quality/presence"


def _with_period(fact: DataFrame) -> DataFrame:
    return fact.withColumns({"year": F.year("flight_date"), "month": F.month("flight_date")})


def ensure_tables(spark: SparkSession, root: str) -> None:
    """Create the star tables that do not exist yet, empty. KPI tables begin with their first release."""
    for path, schema, key in [(DIM_AIRLINE, S.DIM_AIRLINE, "airline_id"), (DIM_AIRPORT, S.DIM_AIRPORT, "airport_id")]:
        if read_snapshot(spark, f"{root}/{path}") is None:
            merge_snapshot(spark, f"{root}/{path}", spark.createDataFrame([], schema), [key])
    ensure_table(spark, f"{root}/{FACT}", S.FACT_FLIGHT)


def load_star_from(
    flights: DataFrame, airlines: DataFrame, airport_ids: DataFrame, coordinates: DataFrame,
    root: str, period: tuple[int, int] | None = None,
) -> None:
    """Upsert both dimensions and replace the fact of one month, or of every month in ``flights``."""
    spark = flights.sparkSession

    def write_fact() -> None:
        fact = with_period_key(_with_period(build_fact(flights)), "flight_id")
        if period is None:
            write_periods(fact, f"{root}/{FACT}")
        else:
            replace_period(fact, f"{root}/{FACT}", *period)

    airports = build_dim_airport(flights, airport_ids, coordinates)
    together(
        spark,
        lambda: merge_snapshot(
            spark, f"{root}/{DIM_AIRLINE}", build_dim_airline(airlines), ["airline_id"]
        ),
        lambda: merge_snapshot(spark, f"{root}/{DIM_AIRPORT}", airports, ["airport_id"]),
        write_fact,
    )


def load_star(spark: SparkSession, root: str, year: int, month: int) -> None:
    """Star schema of one month from its cleaned tables."""

    def silver(name: str) -> DataFrame:
        return scan_period(spark, f"{root}/silver/{name}", year, month, f"silver {name}")

    load_star_from(
        scan_period(spark, f"{root}/{FLIGHTS}", year, month, "silver flights"),
        silver("airlines"), silver("airport_ids"), silver("airport_coordinates"),
        root, (year, month),
    )


def star_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (spark.read.parquet(f"{root}/{FACT}"), read_snapshot(spark, f"{root}/{DIM_AIRLINE}"),
            read_snapshot(spark, f"{root}/{DIM_AIRPORT}"))


def _replace(df: DataFrame, target: str, period: tuple[int, int] | None) -> None:
    if period is None:
        write_periods(df, target)
    else:
        replace_period(df, target, *period)


def build_gold(
    fact: DataFrame, dim_airline: DataFrame, dim_airport: DataFrame, root: str,
    period: tuple[int, int] | None = None,
) -> None:
    """Replace one month, or every month of ``fact``, in the four KPI tables: in all of them at once,
    or, when a write fails, in none (see ``releases``).

    The fact is scanned once: its statistics at flight-number grain and their roll-up to routes are
    written to the scratch folder, which the four tables read and which is then emptied.
    """
    with Scratch(fact.sparkSession) as scratch:
        stats = scratch.staged(flight_stats(fact, FLIGHT_GRAIN), "stats")
        routes = scratch.staged(roll_up(stats, ROUTE_GRAIN), "routes")
        tables = kpi_tables_from_stats(stats, dim_airline, dim_airport, routes)
        release(
            {S.KPI_TABLES[dataset]: evolve(table, S.KPI_SCHEMAS[dataset]) for dataset, table in tables.items()},
            root, None if period is None else [period])


def gold_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four KPI tables as published, every month of the same release in all of them."""
    found = read_months(spark, root, {table: S.KPI_SCHEMAS[dataset] for dataset, table in S.KPI_TABLES.items()})
    return {dataset: found[table] for dataset, table in S.KPI_TABLES.items()}


def check_months(spark: SparkSession, root: str, period: tuple[int, int] | None = None) -> DataFrame:
    """Check one month, or all, and store the findings; then the gate. Returns the stored checks.

    The findings are written before the gate looks at them, so a month that fails can be examined.
    """
    fact, dim_airline, dim_airport = star_tables(spark, root)
    kpis = gold_tables(spark, f"{root}/{GOLD}")
    _replace(quality.dq_suite(fact, dim_airline, dim_airport, kpis, period), f"{root}/{CHECKS}", period)
    _replace(quality.presence_check(fact, kpis, period), f"{root}/{PRESENCE}", period)

    def stored(table: str) -> DataFrame:
        if period is None:
            return spark.read.parquet(f"{root}/{table}")
        return scan_period(spark, f"{root}/{table}", *period, table)

    quality.quality_gate(stored(CHECKS))
    quality.require_presence(stored(PRESENCE))
    return stored(CHECKS)


def run_month(spark: SparkSession, root: str, year: int, month: int, fresh: bool = False) -> DataFrame:
    """Star, KPI tables, quality gate and presence check of one month; returns the stored checks.

    Steps that are done, from the same input files and with their output in place, are not done again
    when a run follows a failed one; ``fresh`` does all of them. Checks always run.
    """
    period, leaf = (year, month), f"year={year}/month={month}"
    tune(spark)
    ensure_tables(spark, root)
    steps = Steps(spark, f"{root}/steps/{leaf}", fresh)
    lookups = ("airlines", "airport_ids", "airport_coordinates")
    steps.run(
        "star", [f"{root}/{FLIGHTS}/{leaf}", *(f"{root}/silver/{name}/{leaf}" for name in lookups)], [f"{root}/{FACT}/{leaf}"],
        lambda: load_star(spark, root, year, month))

    def publish() -> None:
        _, dim_airline, dim_airport = star_tables(spark, root)
        month_fact = scan_period(spark, f"{root}/{FACT}", year, month, "fact")
        build_gold(month_fact, dim_airline, dim_airport, f"{root}/{GOLD}", period)

    steps.run(
        "gold", [f"{root}/{FACT}/{leaf}", f"{root}/{DIM_AIRLINE}", f"{root}/{DIM_AIRPORT}"],
        [f"{root}/{GOLD}/releases/published/{leaf}"], publish)
    return check_months(spark, root, period)
