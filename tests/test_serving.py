import datetime as dt

import pytest
from pyspark.sql import functions as F

from punctua.functions import labels
from punctua.functions.bands import reliability_band
from punctua.operators import geo, periods, ranking, reaggregate, trend

MONTHLY = "year int, month int, name string, code string, flights long, on_time_rate_pct double, " \
    "cancellation_rate_pct double, diversion_rate_pct double, avg_arr_delay_minutes double, " \
    "arr_delay_flights long, arr_delay_sum_minutes long"
MEASURES = ["on_time_rate_pct", "cancellation_rate_pct", "avg_arr_delay_minutes"]


def monthly(spark):
    return spark.createDataFrame([
        (2026, 5, "A", "a", 10, 50.0, None, 1.0, 3.0, 8, 24),
        (2026, 6, "A", "a", 30, 70.0, 2.0, 1.0, 5.5, 20, 110),
        (2026, 5, "B", "b", 20, 33.33, None, 0.0, None, 0, None),
        (2026, 5, None, None, 5, 10.0, 4.0, None, 1.0, 4, 4),
    ], MONTHLY)


def test_aggregate_periods(spark):
    rows = {r.name: r for r in reaggregate.aggregate_periods(monthly(spark), ["name"], MEASURES).collect()}
    assert rows["A"].flights == 40
    assert rows["A"].on_time_rate_pct == pytest.approx((50 * 10 + 70 * 30) / 40)
    # NULL months carry no weight.
    assert rows["A"].cancellation_rate_pct == 2.0
    assert rows["A"].avg_arr_delay_minutes == pytest.approx(134 / 28)
    assert rows["B"].cancellation_rate_pct is None
    assert (rows["B"].avg_arr_delay_minutes, rows["B"].arr_delay_sum_minutes) == (None, 0)
    # NULL keys form a group.
    assert rows[None].flights == 5


def test_one_month_keeps_the_stored_average(spark):
    rows = reaggregate.aggregate_periods(
        monthly(spark).where("month = 6"), ["name"], MEASURES).collect()
    assert round(rows[0].avg_arr_delay_minutes, 2) == 5.5


def test_weighted_average_zero_policies(spark):
    row = reaggregate.weighted_average(monthly(spark).where("name = 'B'"), MEASURES).first()
    assert row.avg_arr_delay_minutes == 0.0
    assert row.cancellation_rate_pct is None
    assert row.on_time_rate_pct == 33.33


def test_total_row_null_policies(spark):
    entities = reaggregate.aggregate_periods(monthly(spark), ["name", "code"], MEASURES)
    names = {"name": "All", "code": "n/a"}
    skip = reaggregate.total_row(entities, names, MEASURES, "skip").first()
    keep = reaggregate.total_row(entities, names, MEASURES, "keep").first()
    assert skip.flights == keep.flights == 65
    assert skip.cancellation_rate_pct == pytest.approx((2.0 * 40 + 4.0 * 5) / 45)
    assert keep.cancellation_rate_pct == pytest.approx((2.0 * 40 + 4.0 * 5) / 65)
    none = reaggregate.total_row(
        entities.where("name = 'B'"), names, MEASURES, "keep").first()
    assert none.cancellation_rate_pct == 0.0
    with pytest.raises(ValueError):
        reaggregate.total_row(entities, names, MEASURES, "other")
    both = reaggregate.with_total(entities, names, MEASURES)
    assert both.where("is_total").count() == 1 and both.count() == 4


def test_thresholds_are_strict(spark):
    df = spark.createDataFrame([("x", 1), ("y", 10), ("z", 89)], "n string, flights long")
    assert {r.n for r in reaggregate.min_share(df, 0.10).collect()} == {"z"}
    assert {r.n for r in reaggregate.min_volume(df, 5, 2).collect()} == {"z"}


def test_select_entities(spark):
    df = monthly(spark)
    assert reaggregate.select_entities(df, "name", ["A"]).count() == 2
    assert reaggregate.select_entities(df, "name", spark.createDataFrame([("B",)], "n string")).count() == 1
    assert reaggregate.select_entities(df, "name", []).count() == 0


def test_top_n_ties_and_nulls(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 2.0)], "k string, m double")
    rows = ranking.top_n(df, "m", 3, ["k"]).orderBy("position").collect()
    assert [r.k for r in rows] == ["d", "a", "b"]


@pytest.mark.parametrize("placement, sort_by, expected", [
    ("first", "metric", ["All", "b", "a", "c"]),
    ("ranked", "metric", ["b", "All", "a", "c"]),
    ("both_ends", "name", ["All", "a", "b", "c", "All"]),
    ("omitted", "metric", ["b", "a", "c"]),
])
def test_rank_with_total(spark, placement, sort_by, expected):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", None)], "n string, m double")
    total = spark.createDataFrame([("All", 2.0)], "n string, m double")
    rows = ranking.rank_with_total(df, total, "m", "n", placement, sort_by).orderBy("position").collect()
    assert [r.n for r in rows] == expected
    assert [r.position for r in rows] == list(range(1, len(expected) + 1))


def test_trend(spark):
    columns = ["on_time_rate_pct", "cancellation_rate_pct", "diversion_rate_pct"]
    rows = trend.kpi_trend(monthly(spark), "name", columns, "All", ["A"]).collect()
    june = {(r["name"], r.metric): r.value for r in rows if r.period == dt.date(2026, 6, 1)}
    assert june["A", "cancel_diversion_rate_pct"] == june["All", "cancel_diversion_rate_pct"] == 3.0
    may = {(r["name"], r.metric): r.value for r in rows if r.period == dt.date(2026, 5, 1)}
    # NULL plus a number stays unknown; the total weighs only what is known.
    assert may["A", "cancel_diversion_rate_pct"] is None
    assert may["All", "cancellation_rate_pct"] == 4.0


def test_labels(spark):
    df = spark.createDataFrame(
        [("JFK", None, "New York", None)],
        "origin_airport_code string, dest_airport_code string, origin_city string, dest_city string")
    row = df.select(
        labels.route_label().alias("r"), labels.display_route().alias("d"),
        labels.place_label("dest_city", "origin_airport_code").alias("p")).first()
    assert tuple(row) == (None, "New York (JFK) →  ()", " (JFK)")


@pytest.mark.parametrize("metric, bands", [
    ("on_time", {80.0: "green", 79.99: "gold", 70.0: "gold", 69.99: "red"}),
    ("delay", {15.0: "green", 15.01: "gold", 25.0: "gold", 25.01: "red"}),
    ("cancellation", {1.0: "green", 3.0: "gold", 3.01: "red"}),
    ("diversion", {0.5: "green", 1.0: "gold", 1.01: "red"}),
])
def test_bands(spark, metric, bands):
    values = [*bands.items(), (None, "red"), (float("nan"), "red")]
    df = spark.createDataFrame(values, "v double, expected string")
    assert df.where(reliability_band(F.col("v"), metric) != F.col("expected")).count() == 0


def test_scaling(spark):
    df = spark.createDataFrame([("a", 4), ("b", 16), ("c", 9)], "n string, flights long")
    sizes = {r.n: r.marker_size for r in geo.marker_size(df).collect()}
    assert sizes == {"a": 15.5, "b": 38.0, "c": pytest.approx(24.875)}
    assert {r.n: r.line_width for r in geo.line_width(df).collect()} == {"a": 1.0, "b": 4.0, "c": 2.5}
    assert {r.line_width for r in geo.line_width(df.where("n = 'a'")).collect()} == {3.0}
    none = df.withColumn("flights", F.lit(0).cast("long"))
    assert {r.marker_size for r in geo.marker_size(none).collect()} == {8.0}


def test_periods(spark):
    assert periods.month_bounds(2026, 12) == (dt.date(2026, 12, 1), dt.date(2027, 1, 1))
    catalog = spark.createDataFrame([(2026, 3), (2026, 5), (2026, 4), (2026, 5)], "year int, month int")
    newest = periods.period_catalog(catalog).collect()
    assert [(r.label, r.is_default) for r in newest] == [
        ("2026-05", True), ("2026-04", False), ("2026-03", False)]

    def chosen(**kwargs):
        return [r.label for r in periods.period_range(catalog, **kwargs).collect()]

    assert chosen() == ["2026-03", "2026-04", "2026-05"]
    assert chosen(selected=[(2026, 4), (2027, 1)]) == ["2026-04", "2026-05"]
    assert chosen(selected=[(2025, 4), (2026, 4)]) == ["2026-03", "2026-04"]
    assert chosen(start=(2026, 5), end=(2026, 3)) == []


@pytest.mark.parametrize("run_date, expected", [
    (dt.date(2026, 7, 2), [(2026, 5, False)]),
    (dt.date(2026, 8, 2), [(2026, 5, True)]),
    (dt.date(2026, 9, 2), []),
])
def test_resolve_period(spark, run_date, expected):
    catalog = spark.createDataFrame([(2026, 4), (2026, 5)], "year int, month int")
    assert [tuple(r) for r in periods.resolve_period(catalog, run_date).collect()] == expected


def test_route_end_points_keep_the_last_appearance(spark):
    df = spark.createDataFrame(
        [(9, "A", "first", 1.0, 1.0, "B", "b", 2.0, 2.0), (3, "B", "b2", 5.0, 5.0, "A", "last", 7.0, 7.0)],
        "flights long, origin_airport_code string, origin_airport_name string, origin_latitude double, "
        "origin_longitude double, dest_airport_code string, dest_airport_name string, "
        "dest_latitude double, dest_longitude double")
    points = {r.code: (r.name, r.lat) for r in geo.route_end_points(df, ["flights"]).collect()}
    assert points == {"A": ("last", 7.0), "B": ("b2", 5.0)}


def test_listings_with_repeated_names_are_the_same_for_any_partitioning(spark):
    data = [(i, f"c{i % 4}", f"City {i % 3}", "S", i % 5) for i in range(60)]
    found = []
    for partitions in (1, 8):
        df = spark.createDataFrame(data, "airport_id int, airport_code string, city string, state string, flights long")
        rows = {m: ranking.entity_sort(df.repartition(partitions), m).orderBy("position").collect() for m in ranking.SORT_MODES
                if m.startswith("airport")}
        found.append({m: [r.airport_id for r in listed] for m, listed in rows.items()})
        total = spark.createDataFrame([("All", 2)], "city string, flights long")
        ranked = ranking.rank_with_total(df.repartition(partitions), total, "flights", "city", "ranked", ids=["airport_id"])
        found[-1]["ranked"] = [r.airport_id for r in ranked.orderBy("position").collect()]
    assert found[0] == found[1]
    assert found[0]["airport_flights"] == [r[0] for r in sorted(data, key=lambda r: (-r[4], r[2], r[1], r[0]))]


def test_flight_number_view_of_one_airline(spark):
    columns = {c: "x" for c in reaggregate.FLIGHT_GROUP}
    rows = [{**columns, "year": 2026, "month": m, "airline_name": a, "flight_number": n, "flights": 10, "on_time_rate_pct": 50.0 * n,
             **{c: 1.0 for c in reaggregate.ROUTE_MEASURES if c != "on_time_rate_pct"}}
            for m in (5, 6) for a, n in (("A", 1), ("A", 2), ("B", 1))]
    monthly = spark.createDataFrame(rows).withColumns({
        c: F.lit(10).cast("long") for c in ("dep_delay_flights", "dep_delay_sum_minutes", "arr_delay_flights", "arr_delay_sum_minutes")})
    view = reaggregate.flight_number_view(monthly, "A").collect()
    assert [(r.airline_name, r.flight_numbers, r.flights, r.overall_on_time_rate) for r in view] == [("A", 2, 40, 75.0)]
