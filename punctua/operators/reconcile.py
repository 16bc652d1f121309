"""Checksums of the KPI tables against the fact.

Every KPI row of a month is reduced to a hash of its ids, its additive columns and its rates in whole
hundredths. What the fact says and what a table holds are added up with opposite signs, so that a month
of a table agrees when the sums of rows, flights and hashes are all zero, whatever the order of rows.
A changed value, a missing, an extra and a doubled row are found, also where flights add up; two errors
would have to cancel in 64 bits to stay hidden. The fact is scanned once for all tables, and nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.functions.rates import percent_2dp
from punctua.operators import kpi
from punctua.operators.kpi import PERIOD

# The checks, in report order.
CHECKSUMS = ["airline_checksum", "departure_checksum", "arrival_checksum", "route_checksum", "flight_checksum"]
IDS = {
    "airline_checksum": kpi.AIRLINE_GRAIN, "departure_checksum": ["airport_id"], "arrival_checksum": ["airport_id"],
    "route_checksum": kpi.ROUTE_GRAIN, "flight_checksum": kpi.FLIGHT_GRAIN,
}
DATASETS = {
    "airline_checksum": "airlines", "departure_checksum": "airports", "arrival_checksum": "airports",
    "route_checksum": "routes", "flight_checksum": "flights",
}
OPERATIONS = {"departure_checksum": "DEP", "arrival_checksum": "ARR"}
TABLE_VALUES = ["flights", "dep_delay_flights", "dep_delay_sum_minutes", "arr_delay_flights", "arr_delay_sum_minutes"]
AIRPORT_VALUES = ["flights", "delay_flights", "delay_sum_minutes"]
RATES = ["on_time_rate_pct", "cancellation_rate_pct", "diversion_rate_pct"]
NOTHING = -(1 << 62)  # what a NULL is hashed as


def _hundredths(rate: Column) -> Column:
    return F.round(rate * 100).cast("long")


def _signed(rows: DataFrame, check: str, values: list[Column], sign: int) -> DataFrame:
    """``year, month, check_name, row_count, flights, hash`` of single rows; the first value is the flights."""
    parts = [F.coalesce(v.cast("long"), F.lit(NOTHING)) for v in [*map(F.col, IDS[check]), *values]]
    return rows.select(
        *PERIOD, F.lit(check).alias("check_name"), F.lit(sign).cast("long").alias("row_count"),
        (F.coalesce(values[0].cast("long"), F.lit(0)) * sign).alias("flights"),
        (F.xxhash64(*parts).cast("decimal(20,0)") * sign).cast("decimal(20,0)").alias("hash"))


def _of_table(rows: DataFrame, check: str) -> DataFrame:
    if check in OPERATIONS:
        rows = rows.where(F.col("operation") == OPERATIONS[check])
    values = AIRPORT_VALUES if check in OPERATIONS else TABLE_VALUES
    return _signed(rows, check, [*map(F.col, values), *[_hundredths(F.col(r)) for r in RATES]], -1)


def _of_fact(stats: DataFrame, check: str) -> DataFrame:
    def rates(on_time: str, flights: str, known: bool = True) -> list[Column]:
        shares = [("cancelled_sum", "cancelled_n"), ("diverted_sum", "diverted_n")]
        return [_hundredths(percent_2dp(F.col(on_time), F.col(flights))), *[
            _hundredths(percent_2dp(F.col(a), F.col(b))) if known else F.lit(None).cast("long") for a, b in shares]]

    if check == "departure_checksum":
        rows = stats.withColumn("airport_id", F.col("origin_airport_id"))
        values = [F.col("flights"), F.col("dep_n"), F.col("dep_sum"), *rates("dep_on_time", "flights")]
    elif check == "arrival_checksum":
        rows = stats.withColumn("airport_id", F.col("dest_airport_id"))
        values = [F.col("completed"), F.col("arr_completed_n"), F.col("arr_completed_sum"), *rates("arr_on_time", "completed", False)]
    else:
        rows = stats
        values = [F.col(c) for c in ("flights", "dep_n", "dep_sum", "arr_n", "arr_sum")] + rates("arr_on_time", "flights")
    if check != "flight_checksum":
        rows = kpi.roll_up(rows, IDS[check])
    return _signed(rows, check, values, 1)


def gold_checksums(stats: DataFrame, kpis: dict[str, DataFrame]) -> DataFrame:
    """``year, month, check_name, error_count`` for every month and checksum that the fact or a table has rows for.

    ``stats`` are the fact's statistics at flight grain (``kpi.flight_stats``), taken from the fact and not
    from a table; they are read five times, so pass them stored. ``error_count`` is 0 where a table agrees, else the difference in
    flights, and 1 at least. Fact rows without a dimension row are in no table and count as differences;
    a table that is missing in ``kpis`` is not checked.
    """
    rows = None
    for check in CHECKSUMS:
        if DATASETS[check] in kpis:
            part = _of_fact(stats, check).unionByName(_of_table(kpis[DATASETS[check]], check))
            rows = part if rows is None else rows.unionByName(part)
    sums = rows.where("year IS NOT NULL").groupBy(*PERIOD, "check_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("flights").alias("flights"), F.sum("hash").alias("hash"))
    agrees = (F.col("row_count") == 0) & (F.col("flights") == 0) & (F.col("hash") == 0)
    return sums.select(
        *PERIOD, "check_name",
        F.when(agrees, F.lit(0)).otherwise(F.greatest(F.lit(1), F.abs("flights"))).cast("long").alias("error_count"))
