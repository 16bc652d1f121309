"""Months of several tables that change all at once.

A release writes every table into new folders that nothing reads yet. A month is then published by
creating one empty file, the marker, whose name is the number of the release; the greatest marker of
a month is in force for all tables. Creating an empty file is atomic on local disks, HDFS and object
stores, so a reader finds a month either as it was in all tables or as it is in all of them, and a
release that fails before its marker has changed nothing.

Numbers are claimed by creating a file that must be new, so that several months can be released at
the same time; of two releases of a month the one begun later is in force. The release before the
one in force is kept for those who are reading it. Only folder and marker names are listed on the
driver, a few per month of history.

    root/releases/claims/<release>                                  numbers in use
    root/releases/published/year=Y/month=M/<release>                markers
    root/releases/tables/<table>/release=<release>/year=Y/month=M   rows
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.sources.concurrent import together
from punctua.sources.storage import read_if_present, remove

Period = tuple[int, int]
KEPT = 2


def _files(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(root).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, pattern: str) -> list[str]:
    path, system = _files(spark, pattern.split("*")[0])
    return [status.getPath().toString() for status in system.globStatus(path(pattern)) or []]


def _period(path: str) -> Period:
    """The period that a path names in its folders ``year=`` and ``month=``."""
    parts = dict(part.split("=", 1) for part in path.split("/") if "=" in part)
    return int(parts["year"]), int(parts["month"])


def _leaf(root: str, table: str, release: str, period: Period) -> str:
    return f"{root}/releases/tables/{table}/release={release}/year={period[0]}/month={period[1]}"


def _marker(root: str, period: Period, release: str) -> str:
    return f"{root}/releases/published/year={period[0]}/month={period[1]}/{release}"


def markers(spark: SparkSession, root: str) -> dict[Period, list[str]]:
    """The markers of every published month, oldest first."""
    found: dict[Period, list[str]] = {}
    for path in sorted(_names(spark, f"{root}/releases/published/year=*/month=*/*"), key=lambda p: p.rsplit("/", 1)[1]):
        found.setdefault(_period(path), []).append(path.rsplit("/", 1)[1])
    return found


def published(spark: SparkSession, root: str) -> dict[Period, str]:
    """The release in force of every published month."""
    return {period: releases[-1] for period, releases in markers(spark, root).items()}


def _claimed(spark: SparkSession, root: str) -> str:
    path, system = _files(spark, root)
    taken = _names(spark, f"{root}/releases/claims/*")
    number = max((int(name.rsplit("/", 1)[1]) for name in taken), default=0) + 1
    while not system.createNewFile(path(f"{root}/releases/claims/{number:012d}")):
        number += 1
    return f"{number:012d}"


def release(frames: dict[str, DataFrame], root: str, periods: Iterable[Period] | None = None) -> str:
    """Replace months in all tables of ``frames`` (rows with ``year`` and ``month``); returns the release.

    ``periods`` are replaced also where there are no rows for them, and rows of other months are left
    out; without ``periods``, every month that a table has rows for is replaced. A month is replaced in
    all tables at once, or, when a write fails, in none.
    """
    spark = next(iter(frames.values())).sparkSession
    number = _claimed(spark, root)
    wanted = None if periods is None else list(periods)

    def write(table: str, rows: DataFrame) -> None:
        if wanted is not None:
            rows = rows.where((F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in wanted]))
        # One month is dealt out evenly, many by their month.
        hint = [] if wanted is not None and len(wanted) == 1 else [F.col("year"), F.col("month")]
        rows.hint("rebalance", *hint).write.partitionBy("year", "month").parquet(f"{root}/releases/tables/{table}/release={number}")

    try:
        together(spark, *[partial(write, table, rows) for table, rows in frames.items()])
    except BaseException:
        for table in frames:
            remove(spark, f"{root}/releases/tables/{table}/release={number}")
        raise
    if wanted is None:
        wanted = sorted({_period(p) for t in frames for p in _names(spark, f"{root}/releases/tables/{t}/release={number}/year=*/month=*")})
    path, system = _files(spark, root)
    for period in wanted:
        system.createNewFile(path(_marker(root, period, number)))
    _prune(spark, root, wanted, list(frames))
    return number


def _prune(spark: SparkSession, root: str, periods: Iterable[Period], tables: list[str]) -> None:
    """Remove the rows and markers of releases that are neither in force nor the one before."""
    known = markers(spark, root)
    for period in periods:
        for old in known[period][:-KEPT]:
            for table in tables:
                remove(spark, _leaf(root, table, old, period))
            remove(spark, _marker(root, period, old))


def read_months(
    spark: SparkSession, root: str, schemas: dict[str, T.StructType], periods: Iterable[Period] | None = None,
) -> dict[str, DataFrame]:
    """Tables as they are in force, all of the same look at the markers; only the files of ``periods``.

    Months that were never released are read from plain period folders ``root/<table>``, if there are any.
    """
    current = published(spark, root)
    wanted = None if periods is None else set(periods)
    chosen = {period: number for period, number in current.items() if wanted is None or period in wanted}
    return {table: _read(spark, root, table, schema, chosen, current, wanted) for table, schema in schemas.items()}


def _read(spark, root, table, schema, chosen, current, wanted) -> DataFrame:
    base = f"{root}/releases/tables/{table}"
    present = {}
    for path in _names(spark, f"{base}/release=*/year=*/month=*") if chosen else []:
        present[(path.split("/release=")[1].split("/")[0], _period(path))] = path
    leaves = [present[(number, period)] for period, number in sorted(chosen.items()) if (number, period) in present]
    rows = None
    if leaves:
        rows = spark.read.schema(schema).option("basePath", base).parquet(*leaves).select(*schema.names)
    plain = read_if_present(spark, f"{root}/{table}")
    if plain is not None:
        plain = plain.select(*schema.names)
        ordinal = F.col("year") * 100 + F.col("month")
        if current:
            plain = plain.where(~ordinal.isin([y * 100 + m for y, m in current]))
        if wanted is not None:
            plain = plain.where(ordinal.isin([y * 100 + m for y, m in wanted]))
        rows = plain if rows is None else rows.unionByName(plain)
    return rows if rows is not None else spark.createDataFrame([], schema)


def _has_rows(spark: SparkSession, leaf: str) -> bool:
    """Whether a file of the folder holds a row, by the row counts of the footers; stops at the first."""
    path, system = _files(spark, leaf)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for status in system.listStatus(path(leaf)):
        if status.getPath().getName().startswith(("_", ".")):
            continue
        file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromStatus(status, conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
        try:
            if reader.getRecordCount() > 0:
                return True
        finally:
            reader.close()
    return False


def stored_periods(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The months that ``table`` has rows for: ``year, month``, without reading a row.

    Months come from folder names, one list per table: a released month without rows has no folder,
    and a plain one is looked into by its files' footers.
    """
    current = published(spark, root)
    leaves = set(_names(spark, f"{root}/releases/tables/{table}/release=*/year=*/month=*")) if current else set()
    found = {
        _period(path) for path in leaves if current.get(_period(path)) == path.split("/release=")[1].split("/")[0]
    }
    for path in _names(spark, f"{root}/{table}/year=*/month=*"):
        period = _period(path)
        if period not in current and period not in found and _has_rows(spark, path):
            found.add(period)
    schema = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
    return spark.createDataFrame(sorted(found), schema)
