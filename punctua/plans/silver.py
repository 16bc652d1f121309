"""Raw files to cleaned tables.

The raw rows are parsed once: cleaned rows and the packed outcomes of their rules are written to the
shared scratch folder. Of the business keys only hashes are shuffled, to find those that occur more
than once; rows of the others are written from where the scan of the monthly files left them. The
report counts the packed words, and the rows that were written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.operators.cleaning import clean_coordinates, clean_flights, clean_lookup, lookup_report
from punctua.operators.rules import (
    PERIOD, count_words, period_rules, repeated_keys, report_of_written, valid_unique, valid_unique_in_place, with_words,
)
from punctua.sources.concurrent import together
from punctua.session import tune
from punctua.sources.delimited import scan_csv, scan_flight_csv
from punctua.sources.storage import Scratch
from punctua.sources.tables import replace_period, write_periods

FLIGHTS, FLIGHT_REPORT = "silver/flights", "silver/flight_report"
LOOKUP_REPORT = "silver/lookup_report"


# Most repeated keys whose hashes are broadcast, about 32 MB, and most months per staged file, on
# average, whose rows stay where they are. Beyond either, whole rows are shuffled.
REPEATED = 1_000_000
MONTHS = 16


def flag_flights(raw: DataFrame) -> DataFrame:
    """Clean all-text rows that carry their filing period and add the rules' packed words."""
    return with_words(clean_flights(raw, keep=PERIOD, malformed=True), period_rules())


def silver_rows(flagged: DataFrame) -> DataFrame:
    """Valid unique rows. ``year``/``month`` of the filing period take the place of the data
    columns ``Year``/``Month``, which the hard rules hold equal to it."""
    return _dated(valid_unique(flagged, period_rules()))


def _dated(rows: DataFrame) -> DataFrame:
    return rows.drop("Year", "Month").withColumnsRenamed(dict(zip(PERIOD, ("year", "month"))))


def _by_month(flagged: DataFrame) -> bool:
    """Whether the staged files hold few months each."""
    pieces = flagged.select(F.col("_metadata.file_path").alias("file"), *PERIOD).distinct()
    files, count = pieces.agg(F.count_distinct("file"), F.count("*")).first()
    return count <= MONTHS * files


def build_silver(raw: DataFrame, root: str, period: tuple[int, int] | None = None) -> None:
    """Write the cleaned flights and the validation report of one period, or of all in ``raw``."""
    tune(raw.sparkSession)

    def write(df: DataFrame, target: str, dealt: bool = False) -> None:
        if period is None:
            write_periods(df, f"{root}/{target}", dealt=dealt)
        else:
            replace_period(df, f"{root}/{target}", *period, dealt=dealt)

    with Scratch(raw.sparkSession) as scratch:
        flagged = scratch.staged(flag_flights(raw), "flagged")
        words, repeated = scratch.path("words"), scratch.path("repeated")
        together(
            raw.sparkSession,
            lambda: repeated_keys(flagged, period_rules()).write.parquet(repeated),
            lambda: count_words(flagged).write.parquet(words),
        )
        repeated = raw.sparkSession.read.parquet(repeated)
        if repeated.count() <= REPEATED and _by_month(flagged):
            write(_dated(valid_unique_in_place(flagged, repeated, period_rules())), FLIGHTS, dealt=True)
        else:
            write(silver_rows(flagged), FLIGHTS)
        # Partition columns only: rows are counted from the files' footers.
        silver = raw.sparkSession.read.parquet(f"{root}/{FLIGHTS}").select(
            *[F.col(own).alias(name) for own, name in zip(("year", "month"), PERIOD)])
        if period is not None:
            silver = silver.where((F.col(PERIOD[0]) == period[0]) & (F.col(PERIOD[1]) == period[1]))
        report = report_of_written(raw.sparkSession.read.parquet(words), silver, period_rules())
        write(report.withColumnsRenamed(dict(zip(PERIOD, ("year", "month")))).withColumn("dataset", F.lit("flights")), FLIGHT_REPORT)


def build_silver_month(spark: SparkSession, bronze: str, root: str, year: int, month: int) -> None:
    build_silver(
        scan_flight_csv(spark, bronze, S.FLIGHT_COLUMNS, year, month), root, (year, month)
    )


def build_silver_lookups(spark: SparkSession, sources: dict[str, str], root: str, year: int, month: int) -> None:
    """Write the cleaned lookups and coordinates of a period.

    ``sources`` maps ``airlines``, ``airports``, ``airport_ids`` and ``airport_coordinates`` to
    their raw folders.
    """
    leaf = f"year={year}/month={month}"
    for name, config in S.LOOKUPS.items():
        raw = scan_csv(spark, sources[name], S.LOOKUP_COLUMNS, name)
        clean_lookup(raw, **config).write.mode("overwrite").parquet(f"{root}/silver/{name}/{leaf}")
        lookup_report(raw, config["code_type"]).withColumn("dataset", F.lit(name)).write.mode(
            "overwrite"
        ).parquet(f"{root}/{LOOKUP_REPORT}/{name}/{leaf}")
    raw = scan_csv(spark, sources["airport_coordinates"], S.COORDINATE_COLUMNS, "airport_coordinates")
    clean_coordinates(raw).write.mode("overwrite").parquet(f"{root}/silver/airport_coordinates/{leaf}")
