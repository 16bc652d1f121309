import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.operators.periods import period_catalog
from punctua.sources import releases
from punctua.sources.tables import replace_period, write_periods

SCHEMA = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
                       T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])
SCHEMAS = {"one": SCHEMA, "two": SCHEMA}


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def content(spark, root, periods=None):
    return {table: sorted(tuple(row) for row in df.collect()) for table, df in releases.read_months(spark, root, SCHEMAS, periods).items()}


def test_a_month_changes_in_all_tables_or_in_none(spark, tmp_path):
    root = str(tmp_path)
    old = rows(spark, (2026, 5, "a", 1), (2026, 6, "a", 2))
    releases.release({"one": old, "two": old}, root)
    before = content(spark, root)
    new = rows(spark, (2026, 6, "b", 3), (2026, 7, "b", 4))
    broken = new.withColumn("n", F.when(F.col("n") > 0, F.raise_error(F.lit("no")).cast("long")))
    with pytest.raises(Exception, match="no"):
        releases.release({"one": new, "two": broken}, root, [(2026, 6)])
    assert content(spark, root) == before
    folders = set(releases._names(spark, f"{root}/releases/tables/*/release=*"))
    assert len(folders) == 2  # what a failed release wrote is gone
    releases.release({"one": new, "two": new.where("false")}, root, [(2026, 6)])
    after = content(spark, root)
    assert after == {"one": [(2026, 5, "a", 1), (2026, 6, "b", 3)], "two": [(2026, 5, "a", 1)]}  # July was not asked for


def test_unpublished_rows_are_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    old = rows(spark, (2026, 6, "a", 1))
    releases.release({"one": old, "two": old}, root)
    before = content(spark, root)
    with monkeypatch.context() as patch:
        patch.setattr(releases, "_marker", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            releases.release({"one": rows(spark, (2026, 6, "b", 2)), "two": rows(spark, (2026, 6, "b", 2))}, root, [(2026, 6)])
    assert content(spark, root) == before


def test_the_release_before_stays_for_its_readers_and_older_ones_go(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        frame = rows(spark, (2026, 6, "a", n), (2026, 5, "a", n))
        if n == 2:
            reading = releases.read_months(spark, root, SCHEMAS)["one"]
        releases.release({"one": frame, "two": frame}, root, [(2026, 6)] if n else None)
    assert releases.markers(spark, root) == {(2026, 6): ["000000000003", "000000000004"], (2026, 5): ["000000000001"]}
    assert content(spark, root)["one"] == [(2026, 5, "a", 0), (2026, 6, "a", 3)]
    with pytest.raises(Exception):
        reading.collect()  # it read the second release, which has gone
    assert content(spark, root, [(2026, 5)])["two"] == [(2026, 5, "a", 0)]


def test_the_release_begun_later_wins(spark, tmp_path):
    root = str(tmp_path)
    first = releases._claimed(spark, root)
    frame = rows(spark, (2026, 6, "late", 1))
    second = releases.release({"one": frame, "two": frame}, root)
    assert first < second
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(releases, "_claimed", lambda *_: first)
        early = rows(spark, (2026, 6, "early", 1))
        releases.release({"one": early, "two": early}, root)
    assert content(spark, root)["one"] == [(2026, 6, "late", 1)]


def test_months_never_released_are_read_from_plain_folders(spark, tmp_path):
    root = str(tmp_path)
    assert content(spark, root) == {"one": [], "two": []}
    write_periods(rows(spark, (2026, 5, "plain", 1), (2026, 6, "plain", 1)), f"{root}/one")
    assert content(spark, root) == {"one": [(2026, 5, "plain", 1), (2026, 6, "plain", 1)], "two": []}
    releases.release({"one": rows(spark, (2026, 6, "new", 1))}, root)
    assert content(spark, root)["one"] == [(2026, 5, "plain", 1), (2026, 6, "new", 1)]
    assert content(spark, root, [(2026, 5)])["one"] == [(2026, 5, "plain", 1)]


def test_only_files_of_the_wanted_months_are_read(spark, tmp_path):
    root = str(tmp_path)
    releases.release({"one": rows(spark, (2026, 5, "a", 1), (2026, 6, "a", 1))}, root)
    files = releases.read_months(spark, root, {"one": SCHEMA}, [(2026, 6)])["one"].inputFiles()
    assert files and all("month=6" in file for file in files)


def test_periods_come_from_names_and_footers(spark, tmp_path):
    root = str(tmp_path)
    write_periods(rows(spark, (2026, 3, "plain", 1), (2026, 4, "plain", 1), (2026, 5, "plain", 1)), f"{root}/one")
    replace_period(rows(spark), f"{root}/one", 2026, 4)
    releases.release({"one": rows(spark, (2026, 6, "a", 1), (2026, 7, "a", 1))}, root)
    releases.release({"one": rows(spark)}, root, [(2026, 5), (2026, 7)])
    found = releases.stored_periods(spark, root, "one")
    assert [tuple(row) for row in found.collect()] == [(2026, 3), (2026, 6)]
    plan = period_catalog(found)._jdf.queryExecution().toString()
    assert "FileScan" not in plan and [row.label for row in period_catalog(found).collect()] == ["2026-06", "2026-03"]
    assert releases.stored_periods(spark, root, "none").count() == 0
