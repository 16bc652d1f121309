"""Data-quality checks over the star schema and the KPI tables.

Every check is a row ``year, month, check_name, error_count``. All periods are checked in one run
(one pass per table, however many months there are); pass a period to check just that one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.operators import reconcile
from punctua.operators.periods import month_slice

# Check names, in report order.
CHECKS = [
    "invalid_required_fields", "invalid_flags", "unknown_airlines", "unknown_origin_airports",
    "unknown_dest_airports", "duplicate_flights", "invalid_airline_kpis", "invalid_airport_kpis",
    "invalid_route_kpis", "fact_vs_airline_gold",
]
RATES = ["on_time_rate_pct", "cancellation_rate_pct", "diversion_rate_pct"]
PERIOD = ["year", "month"]


def _dated(fact: DataFrame, period: tuple[int, int] | None) -> DataFrame:
    """Fact rows of the checked months with ``year`` and ``month``; undated rows belong to none."""
    rows = month_slice(fact, "flight_date", *period) if period else fact.where("flight_date IS NOT NULL")
    return rows.withColumns({"year": F.year("flight_date"), "month": F.month("flight_date")})


def _any(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


FACT_FINDINGS = CHECKS[:6]
GRAIN = ["airline_id", "origin_airport_id", "dest_airport_id"]


def fact_summary(rows: DataFrame) -> DataFrame:
    """One pass over the fact: per month, airline and route ``rows``, ``missing``, ``bad_flags`` and
    ``doubled`` (business keys, NULL parts included, that occur more than once).

    The rows are counted per business key, the one wide shuffle, and rolled up. The KPI tables play
    no part in it, so they can be verified against it.
    """
    missing = _any([F.col(c).isNull() for c in S.FACT_REQUIRED])
    bad_flag = _any([~F.col(c).isin(0, 1) for c in ("cancelled", "diverted")])
    keys = rows.groupBy(*PERIOD, *S.FACT_BUSINESS_KEY).agg(
        F.count("*").alias("rows"), F.count_if(missing).alias("missing"), F.count_if(bad_flag).alias("bad_flags"))
    return keys.groupBy(*PERIOD, *GRAIN).agg(
        *[F.sum(c).alias(c) for c in ("rows", "missing", "bad_flags")],
        F.count_if(F.col("rows") > 1).alias("doubled"),
    )


def _known(summary: DataFrame, dim: DataFrame, primary_key: str, foreign_key: str) -> DataFrame:
    keys = dim.select(F.col(primary_key).alias(foreign_key), F.lit(True).alias(f"known_{foreign_key}")).distinct()
    return summary.join(keys, foreign_key, "left")


def fact_findings(summary: DataFrame, dim_airline: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Per month the fact's checks, one column each, and its ``rows``. Keys that are NULL or unknown
    to their dimension count all their rows."""
    for dim, primary, foreign in [
        (dim_airline, "airline_id", "airline_id"), (dim_airport, "airport_id", "origin_airport_id"),
        (dim_airport, "airport_id", "dest_airport_id"),
    ]:
        summary = _known(summary, dim, primary, foreign)

    def unknown(key: str) -> Column:
        return F.sum(F.when(F.col(f"known_{key}").isNull(), F.col("rows")).otherwise(0))

    values = [F.sum("missing"), F.sum("bad_flags"), *map(unknown, GRAIN), F.sum("doubled")]
    return summary.groupBy(*PERIOD).agg(
        *[value.alias(check) for value, check in zip(values, FACT_FINDINGS)], F.sum("rows").alias("rows"))


def kpi_findings(kpis: dict[str, DataFrame]) -> DataFrame:
    """Per month and KPI table the rows out of range and the flights, one column each.

    A row is out of range with negative flights or a rate outside 0..100; NULL rates pass.
    """
    rows = None
    for dataset in ("airlines", "airports", "routes"):
        bad = _any([F.col("flights") < 0] + [~F.col(c).between(0, 100) for c in RATES])
        part = kpis[dataset].select(*PERIOD, F.lit(dataset).alias("dataset"), "flights", bad.alias("bad"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(*PERIOD).agg(
        *[F.count_if(F.coalesce("bad", F.lit(False)) & (F.col("dataset") == d)).alias(f"invalid_{d[:-1]}_kpis")
          for d in ("airlines", "airports", "routes")],
        *[F.coalesce(F.sum(F.when(F.col("dataset") == d, F.col("flights"))), F.lit(0)).alias(f"{d}_flights")
          for d in ("airlines", "routes")],
    )


def dq_suite(
    fact: DataFrame, dim_airline: DataFrame, dim_airport: DataFrame, kpis: dict[str, DataFrame],
    period: tuple[int, int] | None = None, reconcile_routes: bool = False, stats: DataFrame | None = None,
) -> DataFrame:
    """The ten checks for every month (or one period): ``year, month, check_name, error_count``, with
    a row for every check of every month that the fact or a KPI table holds, zero included.

    The fact is scanned once and each KPI table once. ``reconcile_routes`` adds an eleventh check,
    of the route table against the fact. ``stats``, stored statistics of the fact at flight grain, add
    the checksums of all four tables (``reconcile.gold_checksums``).
    """
    rows = _dated(fact, period)
    if period:
        kpis = {
            name: table.where((F.col("year") == period[0]) & (F.col("month") == period[1]))
            for name, table in kpis.items()
        }
    parts = [fact_findings(fact_summary(rows), dim_airline, dim_airport), kpi_findings(kpis)]
    if period:
        parts.append(fact.sparkSession.createDataFrame([period], "year int, month int"))
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    counts = [c for c in united.columns if c not in PERIOD]
    wide = united.groupBy(*PERIOD).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    names = list(CHECKS)
    wide = wide.withColumn("fact_vs_airline_gold", F.abs(F.col("rows") - F.col("airlines_flights")))
    if reconcile_routes:
        names.append("fact_vs_route_gold")
        wide = wide.withColumn("fact_vs_route_gold", F.abs(F.col("rows") - F.col("routes_flights")))
    found = wide.unpivot(PERIOD, names, "check_name", "error_count")
    if stats is None:
        return found
    if period:
        stats = stats.where((F.col("year") == period[0]) & (F.col("month") == period[1]))
    return found.unionByName(reconcile.gold_checksums(stats, kpis))


def _report_place() -> Column:
    listed = [*CHECKS, "fact_vs_route_gold", *reconcile.CHECKSUMS]
    return F.array_position(F.array(*[F.lit(c) for c in listed]), F.col("check_name"))


def gate_summary(results: DataFrame) -> DataFrame:
    """Verdict per month: ``failed_checks``, ``first_failure`` in report order, ``passed``."""
    failed = F.col("error_count") != 0
    return results.groupBy(*PERIOD).agg(
        F.count_if(failed).alias("failed_checks"),
        F.min_by("check_name", F.when(failed, _report_place())).alias("first_failure"),
    ).withColumn("passed", F.col("failed_checks") == 0)


def quality_gate(results: DataFrame) -> None:
    """Raise when a check failed, naming every failure; passes silently when all counts are 0."""
    failed = results.where("error_count <> 0").orderBy(*PERIOD, _report_place(), "check_name").collect()
    if failed:
        raise ValueError(f"{len(failed)} failed checks: " + "; ".join(
            f"{r.year}-{r.month:02d} {r.check_name}: {r.error_count}" for r in failed))


def presence_check(
    fact: DataFrame, kpis: dict[str, DataFrame], period: tuple[int, int] | None = None
) -> DataFrame:
    """Rows per table and month: ``year, month, table_name, row_count, present``.

    Lists every table for every month that any table holds, so an empty table shows up as 0.
    """
    frames = {"fact_flight": _dated(fact, period)}
    for dataset, table in kpis.items():
        if period:
            table = table.where((F.col("year") == period[0]) & (F.col("month") == period[1]))
        frames[S.KPI_TABLES[dataset]] = table
    counts = None
    for name, frame in frames.items():
        count = frame.groupBy(*PERIOD).agg(F.count("*").alias(name))
        named = count.select(*PERIOD, *[
            (F.col(name) if n == name else F.lit(0).cast("long")).alias(n) for n in frames
        ])
        counts = named if counts is None else counts.unionByName(named)
    if period:
        empty = fact.sparkSession.createDataFrame([period], "year int, month int")
        counts = counts.unionByName(
            empty.select(*PERIOD, *[F.lit(0).cast("long").alias(n) for n in frames])
        )
    wide = counts.groupBy(*PERIOD).agg(*[F.sum(n).alias(n) for n in frames])
    return wide.unpivot(PERIOD, list(frames), "table_name", "row_count").withColumn(
        "present", F.col("row_count") > 0
    )


def require_presence(presence: DataFrame) -> None:
    """Raise when a table has no rows for a checked month, naming every such table."""
    missing = presence.where("NOT present").orderBy(*PERIOD, "table_name").collect()
    if missing:
        raise ValueError("empty tables: " + "; ".join(f"{r.year}-{r.month:02d} {r.table_name}" for r in missing))
