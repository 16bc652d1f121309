"""Delimited scans. Every cell is read as text; typing happens later and never aborts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua.operators.cleaning import require_columns
from punctua.sources.files import (
    CSV_PATTERN, ZIP_PATTERN, UnusableFiles, delimited_heads, list_files, listed_members, member_rows,
)
from punctua.sources.storage import staged


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _one_spelling(uri: Column) -> Column:
    return F.regexp_replace(uri, "^file:/+", "file:/")


def scan_csv(
    spark: SparkSession, path: str | list[str], required: list[str], name: str = "input"
) -> DataFrame:
    """Scan all CSV files under ``path`` and return the required columns as text.

    Columns are matched by header name in every file. One pass reads the headers, a task per few
    files, and is written once. Where all files share a header, they are read by it, and only
    selected cells are parsed. Otherwise all files are read in one scan by position, and each row
    picks its cells through the header of its file, however many different headers there are.
    Raises ``FileNotFoundError`` when there is no file and ``ValueError`` naming the missing columns.
    """
    try:
        files = list_files(spark, path, CSV_PATTERN)
    except Exception as error:
        if getattr(error, "getCondition", lambda: None)() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{name}: no such path: {path}") from error
        raise
    # Empty files carry neither header nor rows.
    heads = staged(delimited_heads(files).where("length > 0").select("uri", "header"), "heads")
    size, common, other = heads.agg(
        F.max(F.size("header")), F.min("header"), F.max("header")).first()
    if not size:
        raise FileNotFoundError(f"{name}: no CSV file with a header under {path}")
    lacking = heads.where(F.size(F.array_except(F.array(*map(F.lit, required)), "header")) > 0)
    for row in lacking.limit(1).collect():
        require_columns(row.header, required, name)

    def read(names: list[str]) -> DataFrame:
        return (
            spark.read.schema(text_schema(names)).option("header", True)
            .option("recursiveFileLookup", True).option("pathGlobFilter", CSV_PATTERN).csv(path)
        )

    source = F.col("_metadata.file_path").alias("source_file")
    if common == other and len(set(common)) == len(common):
        return read(common).select(*required, source)
    cells = [f"_{i}" for i in range(size)]
    rows = read(cells).select(source, F.array(*cells).alias("cells"))
    # A row per file against all rows: Spark broadcasts the headers as long as they are small.
    placed = rows.join(heads, _one_spelling(rows["source_file"]) == _one_spelling(heads["uri"]))
    return placed.select(
        *[F.element_at("cells", F.array_position("header", c).cast("int")).alias(c) for c in required], "source_file"
    )


def period_of_path(path: str = "source_file") -> tuple[Column, Column]:
    """Year and month of a ``…year=YYYY/…month=MM/`` path as (period_year, period_month).

    Taken from the path and kept apart from the data columns ``Year`` and ``Month``, which the
    partition values would otherwise silently replace.
    """
    year = F.regexp_extract(F.col(path), r"year=(\d+)/", 1).try_cast("int")
    month = F.regexp_extract(F.col(path), r"month=(\d+)/", 1).try_cast("int")
    return year.alias("period_year"), month.alias("period_month")


def scan_flight_csv(
    spark: SparkSession, root: str, required: list[str], year: int | None = None, month: int | None = None
) -> DataFrame:
    """Raw monthly files under ``root/year=…/month=…``: one period, or all when none is given."""
    path = root if year is None else f"{root}/*year={year}/*month={{{month},{month:02d}}}"
    scan = scan_csv(spark, path, required, "flights")
    return scan.select(*required, *period_of_path())


def scan_zipped_csv(
    spark: SparkSession, path: str | list[str], required: list[str], pattern: str = ZIP_PATTERN,
    skip_bad: bool = False,
) -> DataFrame:
    """Rows of the CSV members of all archives under ``path``, required columns as text.

    Each member is read exactly once and written to the scratch folder together with the verdicts of
    that pass. Archives that are empty, no archives, damaged or without a required column raise
    ``UnusableFiles`` naming all of them; with ``skip_bad`` they are left out, all rows of a damaged
    archive included, and ``bad_archives`` of the same path lists them.
    """
    members = listed_members(spark, path, pattern)
    rows = staged(member_rows(members, required), "members")
    bad = rows.where("problem IS NOT NULL").select("path", "problem").distinct()
    found = [tuple(row) for row in bad.orderBy("path", "problem").collect()]
    if found and not skip_bad:
        raise UnusableFiles("archives", found)
    good = rows.where("problem IS NULL")
    if found:
        good = good.join(bad.select("path").distinct(), "path", "left_anti")
    if rows.isEmpty() and members.where(F.lower("member").endswith(".csv")).isEmpty():
        raise FileNotFoundError(f"no CSV member in any archive under {path}")
    return good.select(*required)


def bad_archives(
    spark: SparkSession, path: str | list[str], required: list[str], pattern: str = ZIP_PATTERN
) -> DataFrame:
    """``path, member, problem`` of what ``scan_zipped_csv`` cannot read."""
    return member_rows(listed_members(spark, path, pattern), required).where("problem IS NOT NULL").select(
        "path", "member", "problem")
