import random

import pytest
from pyspark.sql import functions as F

from punctua.operators import cumulative, reaggregate
from punctua.sources import tables

SCHEMA = "year int, month int, name string, flights long, on_time_rate_pct double, cancellation_rate_pct double, " \
    "avg_arr_delay_minutes double, arr_delay_flights long, arr_delay_sum_minutes long, extra string"
MEASURES = ["on_time_rate_pct", "cancellation_rate_pct", "avg_arr_delay_minutes"]
GROUP = ["name"]


def history(spark):
    """Ten months over a turn of the year; a month without any rows, entities that come and go, NULLs."""
    rng = random.Random(5)
    rows = []
    for at in range(2025 * 12 + 7, 2025 * 12 + 17):
        for name in ("a", "b", None, "late", "gone"):
            if at == 2025 * 12 + 10 or rng.random() < 0.3 or (name == "late" and at < 2025 * 12 + 14) or (name == "gone" and at > 2025 * 12 + 9):
                continue
            flights, n = rng.randint(0, 50), rng.randint(0, 9)
            rows.append((at // 12, at % 12 + 1, name, flights, rng.choice([None, round(rng.random() * 100, 2)]),
                         rng.choice([None, 1.25]), None, n, rng.choice([None, n * 7]), "x"))
    return spark.createDataFrame(rows, SCHEMA)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_range_equals_the_rows_of_its_months(spark):
    monthly = history(spark).cache()
    stored = cumulative.snapshots(monthly, GROUP, MEASURES).cache()
    found = {}
    for row in cumulative.ranges_kpi(stored, cumulative.all_ranges(monthly), GROUP, MEASURES).collect():
        found.setdefault(row.range_id, []).append(tuple(row)[1:])
    rows = [r.asDict() for r in monthly.withColumn("at", cumulative.serial()).collect()]
    low, high = min(r["at"] for r in rows), max(r["at"] for r in rows)
    for first in range(low, high + 1):
        for last in range(first, high + 1):
            expected = {}
            for r in rows:
                if first <= r["at"] <= last:
                    expected[r["name"]] = expected.get(r["name"], 0) + r["flights"]
            got = {r[0]: r[1] for r in found.get(first * 100000 + last, [])}
            assert got == expected
    for first, last in [((2025, 8), (2026, 5)), ((2025, 12), (2026, 2)), ((2025, 11), (2025, 11)), ((2024, 1), (2025, 9))]:
        inside = monthly.where((F.col("year") * 100 + F.col("month")).between(first[0] * 100 + first[1], last[0] * 100 + last[1]))
        assert collected(cumulative.range_kpi(stored, first, last, GROUP, MEASURES)) == \
            collected(reaggregate.aggregate_periods(inside, GROUP, MEASURES))
    assert cumulative.range_kpi(stored, (2026, 2), (2025, 12), GROUP, MEASURES).collect() == []


def test_extending_equals_building(spark):
    monthly = history(spark)
    built = cumulative.snapshots(monthly, GROUP, MEASURES)
    before = built.where("year = 2025 AND month = 12")
    added = cumulative.extend(before, monthly, (2026, 1), GROUP, MEASURES)
    assert added.columns == built.columns
    assert collected(added) == collected(built.where("year = 2026 AND month = 1"))


def test_a_range_reads_two_months(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    tables.write_periods(cumulative.snapshots(history(spark), GROUP, MEASURES), root)
    stored = spark.read.parquet(root)
    picked = cumulative.range_kpi(stored.withColumn("file", F.input_file_name()), (2025, 10), (2026, 3), [*GROUP, "file"], MEASURES)
    files = {r.file for r in picked.select("file").distinct().collect()}
    assert files and all("year=2026/month=3" in f for f in files)
    plan = cumulative.range_kpi(stored, (2025, 10), (2026, 3), GROUP, MEASURES)
    plan.collect()
    scans = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("FileScan")[1:]
    assert len(scans) == 1
    filters = scans[0].split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert all(value in filters for value in ("= 2025)", "= 9)", "= 2026)", "= 3)"))


def test_empty_history(spark):
    empty = spark.createDataFrame([], SCHEMA)
    stored = cumulative.snapshots(empty, GROUP, MEASURES)
    assert stored.collect() == []
    assert cumulative.ranges_kpi(stored, cumulative.all_ranges(empty), GROUP, MEASURES).collect() == []


@pytest.mark.parametrize("first, last", [((2025, 8), (2025, 8)), ((2025, 9), (2026, 4))])
def test_extra_columns_do_not_matter(spark, first, last):
    monthly = history(spark).withColumn("months", F.lit("clash"))
    stored = cumulative.snapshots(monthly, GROUP, MEASURES)
    inside = monthly.where((F.col("year") * 100 + F.col("month")).between(first[0] * 100 + first[1], last[0] * 100 + last[1]))
    assert collected(cumulative.range_kpi(stored, first, last, GROUP, MEASURES)) == \
        collected(reaggregate.aggregate_periods(inside, GROUP, MEASURES))


def test_ranges_shuffle_the_snapshots_alone(spark):
    """However many ranges there are: no exchange above the place where they meet the entities."""
    monthly = history(spark).localCheckpoint()
    stored = cumulative.snapshots(monthly, GROUP, MEASURES).localCheckpoint()
    plan = cumulative.ranges_kpi(stored, cumulative.all_ranges(monthly), GROUP, MEASURES)._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Join Cross" if "Join Cross" in plan else "Join Inner")[0]
    assert "Aggregate" not in above and "Join" not in above and "Repartition" not in above


def test_ranges_of_one_id_gaps_and_repeated_snapshots(spark):
    """As the sum over all snapshots that are an end of a range of that id."""
    monthly = history(spark)
    stored = cumulative.snapshots(monthly, GROUP, MEASURES)
    low = 2025 * 12 + 7
    odd = stored.where(cumulative.serial() != low + 4)
    odd = odd.union(odd.where(cumulative.serial() == low + 6)).localCheckpoint()
    spans = [(1, low, low + 6), (1, low + 7, low + 8), (2, low + 5, low + 9), (3, low + 2, low + 4), (None, low, low + 3),
             (4, low + 5, low + 2), (5, low - 9, low + 6), (6, low + 3, low + 40), (7, None, low + 6)]
    ranges = spark.createDataFrame(spans, "range_id long, first int, last int")
    expected = {}
    for row in odd.withColumn("at", cumulative.serial()).collect():
        for range_id, first, last in spans:
            sign = 0 if first is None or first > last else (row.at == last) - (row.at == first - 1)
            if sign:
                cell = expected.setdefault((range_id, row["name"]), [0, 0])
                cell[0] += sign * row.months
                cell[1] += sign * row.flights
    found = {(r.range_id, r["name"]): r.flights for r in cumulative.ranges_kpi(odd, ranges, GROUP, MEASURES).collect()}
    assert found == {key: flights for key, (months, flights) in expected.items() if months > 0}
