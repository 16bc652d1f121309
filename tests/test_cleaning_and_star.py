import pytest
from pyspark.sql import functions as F

from punctua.functions import cells
from punctua.operators.cleaning import clean_coordinates, clean_lookup, lookup_report
from punctua.operators.dedup import dedup, duplicate_keys
from punctua.operators.star import build_dim_airline
from punctua.schemas import COORDINATE_COLUMNS, LOOKUPS


def lookup(spark, *rows):
    return spark.createDataFrame(rows, "Code string, Description string")


def test_integer_lookup(spark):
    raw = lookup(spark, (" 7 ", " Seven: S7 "), ("x", "Bad"), ("8", " "), ("7", "Also seven"), (None, "No"))
    rows = clean_lookup(raw, **LOOKUPS["airlines"]).collect()
    assert [tuple(r) for r in rows] == [(7, "Also seven")]
    report = {r.metric: r.value for r in lookup_report(raw, "integer").collect()}
    assert report == {
        "bronze_rows": 5, "missing_code": 2, "missing_description": 1, "duplicate_codes": 1,
        "silver_rows": 1, "total_rejected": 4,
    }


def test_text_lookup_is_upper_cased(spark):
    rows = clean_lookup(lookup(spark, (" jfk", "Kennedy")), **LOOKUPS["airports"]).collect()
    assert [tuple(r) for r in rows] == [("JFK", "Kennedy")]


@pytest.mark.parametrize("label, first, last", [
    ("Delta Air Lines Inc.: DL", ("Delta Air Lines Inc.", "DL"), ("Delta Air Lines Inc.", "DL")),
    ("Mackey: Int: MAC", ("Mackey", "INT"), ("Mackey: Int", "MAC")),
    ("No colon", ("", ""), ("", "")),
    (None, (None, None), (None, None)),
])
def test_name_and_code(spark, label, first, last):
    df = spark.createDataFrame([(label,)], "label string")
    assert tuple(df.select(*cells.split_name_code(F.col("label"))).first()) == first
    assert tuple(df.select(*cells.split_name_code(F.col("label"), True)).first()) == last


@pytest.mark.parametrize("label, parts", [
    ("New York, NY", ("New York", "NY")), ("St. John, Town, VI", ("St. John, Town", "VI")),
    ("New York", ("", "")), ("New York, ny", ("", "")), ("New York, NY\n", ("", "")),
])
def test_city_and_state(spark, label, parts):
    df = spark.createDataFrame([(label,)], "label string")
    assert tuple(df.select(*cells.split_city_state(F.col("label"))).first()) == parts


def test_airport_name(spark):
    df = spark.createDataFrame([("New York, NY: John F. Kennedy International",)], "label string")
    assert df.select(cells.airport_name(F.col("label"))).first()[0] == "John F. Kennedy International"


def test_airlines_without_a_name_are_dropped(spark):
    raw = spark.createDataFrame([(1, "A: x"), (2, "no colon"), (None, "B: y")], "AirlineID int, AirlineName string")
    assert [tuple(r) for r in build_dim_airline(raw).collect()] == [(1, "A", "X")]


def test_coordinates(spark):
    def row(identity, latitude, longitude, latest="1"):
        return (identity, "a", "n", "c", "s", latitude, longitude, latest)

    raw = spark.createDataFrame(
        [row("1", "10.5", "20"), row("2", "91", "0"), row("3", "0", "-181"), row(None, "0", "0"),
         row("4", "0", "0", "0"), row("1", "10.5", "30"), row("5", "north", "0"), row("6", "-90", "180")],
        ", ".join(f"{c} string" for c in COORDINATE_COLUMNS),
    )
    assert sorted((r.AirportID, r.Longitude) for r in clean_coordinates(raw).collect()) == [(1, 20.0), (6, 180.0)]


def test_dedup_is_deterministic_and_treats_nulls_as_equal(spark):
    data = [(1, "b", 2), (1, "a", 9), (None, "z", 1), (None, "y", 1), (2, "c", 3)]
    expected = [(None, "y", 1), (1, "a", 9), (2, "c", 3)]
    for partitions in (1, 5):
        df = spark.createDataFrame(data, "k int, v string, n int").repartition(partitions)
        rows = sorted((tuple(r) for r in dedup(df, ["k"]).collect()), key=lambda r: (r[0] is not None, r[0]))
        assert rows == expected


def test_dedup_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = dedup(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    assert [tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]
