import pytest
from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.sources import buckets


def dim(spark, *rows):
    return spark.createDataFrame(rows, S.DIM_AIRLINE)


def content(spark, root):
    return sorted(tuple(row) for row in buckets.read_buckets(spark, root).collect())


def files(spark, root):
    return set(buckets.read_buckets(spark, root).inputFiles())


def test_a_merge_rewrites_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path)
    assert buckets.read_buckets(spark, root) is None
    buckets.merge_buckets(spark, root, dim(spark, *[(i, f"name {i}", "A") for i in range(200)]), ["airline_id"], 16)
    before = files(spark, root)
    buckets.merge_buckets(spark, root, dim(spark, (7, "new", None), (1000, "more", "M")), ["airline_id"], 16)
    after = files(spark, root)
    assert 1 <= len(after - before) <= 2 and len(before & after) >= 14
    assert content(spark, root) == sorted([(i, f"name {i}", "A") if i != 7 else (7, "new", None) for i in range(200)] + [(1000, "more", "M")])


def test_a_failed_merge_leaves_the_old_state(spark, tmp_path):
    root = str(tmp_path)
    buckets.merge_buckets(spark, root, dim(spark, (1, "a", "A"), (2, "b", "B")), ["airline_id"], 4)
    before, rows = files(spark, root), content(spark, root)
    with pytest.raises(ZeroDivisionError):
        buckets.merge_buckets(spark, root, dim(spark, (1, "x", "X")), ["airline_id"], 4, lambda: 1 / 0)
    broken = dim(spark, (1, "x", "X")).withColumn("airline_name", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        buckets.merge_buckets(spark, root, broken, ["airline_id"], 4)
    with pytest.raises(ValueError, match="more than once"):
        buckets.merge_buckets(spark, root, dim(spark, (1, "x", "X"), (1, "y", "Y")), ["airline_id"], 4)
    assert (files(spark, root), content(spark, root)) == (before, rows)
    buckets.merge_buckets(spark, root, dim(spark, (1, "x", "X")), ["airline_id"], 4)
    assert content(spark, root) == [(1, "x", "X"), (2, "b", "B")]


def test_columns_may_be_added_and_nothing_may_come(spark, tmp_path):
    root = str(tmp_path)
    buckets.merge_buckets(spark, root, spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, name string"), ["id"], 8)
    buckets.merge_buckets(spark, root, spark.createDataFrame([(2, 9), (4, 8)], "id int, rank int"), ["id"], 8)
    rows = {row.id: (row.name, row["rank"]) for row in buckets.read_buckets(spark, root).select("id", "name", "rank").collect()}
    assert rows == {1: ("a", None), 2: (None, 9), 3: ("c", None), 4: (None, 8)}
    before = files(spark, root)
    buckets.merge_buckets(spark, root, spark.createDataFrame([], "id int, name string"), ["id"], 8)
    assert files(spark, root) == before


def test_the_version_before_stays_readable(spark, tmp_path):
    root = str(tmp_path)
    buckets.merge_buckets(spark, root, dim(spark, (1, "a", "A")), ["airline_id"], 2)
    reading = buckets.read_buckets(spark, root)
    buckets.merge_buckets(spark, root, dim(spark, (1, "b", "B")), ["airline_id"], 2)
    assert reading.first().airline_name == "a"
    buckets.merge_buckets(spark, root, dim(spark, (1, "c", "C")), ["airline_id"], 2)
    assert content(spark, root) == [(1, "c", "C")]
    assert len(buckets._listed(spark, f"{root}/rows/version=*/bucket=*")) == 2
