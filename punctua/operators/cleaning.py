"""Raw text rows to typed, cleaned rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.functions import cells
from punctua.operators.dedup import dedup


def require_columns(columns: Iterable[str], required: Iterable[str], name: str = "input") -> None:
    """Raise when mandatory columns are missing, naming all of them."""
    present = set(columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(f"{name} lacks columns: {', '.join(missing)}")


def column_presence(df: DataFrame, wanted: list[str]) -> DataFrame:
    """``column_name, present, filled_rows`` for each wanted column, counted in one pass."""
    counts = [
        (F.count(F.col(c)) if c in df.columns else F.lit(0).cast("long")).alias(c) for c in wanted
    ]
    present = F.array(*[F.lit(c) for c in wanted if c in df.columns])
    return (
        df.agg(F.count("*").alias("_rows"), *counts)
        .unpivot([], wanted, "column_name", "filled_rows")
        .select("column_name", F.array_contains(present, F.col("column_name")).alias("present"), "filled_rows")
    )


def clean_flights(raw: DataFrame, keep: Iterable[str] = (), malformed: bool = False) -> DataFrame:
    """Select, type and clean the mandatory flight columns of all-text rows.

    ``keep`` names further columns to carry along. ``malformed=True`` adds ``malformed_mask``:
    bit *i* is set when the *i*-th of ``TYPED_COLUMNS`` had content that its type rejects.
    """
    require_columns(raw.columns, S.FLIGHT_COLUMNS, "flights")
    typed = {}
    for name in S.FLIGHT_COLUMNS:
        cell = F.col(name)
        if name in S.FLIGHT_DATE_COLUMNS:
            typed[name] = cells.calendar_date(cell)
        elif name in S.FLIGHT_CODE_COLUMNS:
            typed[name] = cells.code_text(cell)
        elif name in S.FLIGHT_TEXT_COLUMNS:
            typed[name] = cells.plain_text(cell)
        else:
            typed[name] = cells.whole_number(cell)
    columns = [expr.alias(name) for name, expr in typed.items()] + [F.col(c) for c in keep]
    if not malformed:
        return raw.select(*columns)
    # Raw cells go along one step, so that the mask reads typed columns and no cell is cast twice.
    both = raw.select(*columns, *[F.col(c).alias(f"_raw_{c}") for c in TYPED_COLUMNS])
    mask = F.lit(0).cast("long")
    for i, name in enumerate(TYPED_COLUMNS):
        bad = cells.is_malformed(F.col(f"_raw_{name}"), F.col(name))
        mask = mask.bitwiseOR(F.when(bad, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return both.select(*typed, *keep, mask.alias("malformed_mask"))


TYPED_COLUMNS = S.FLIGHT_DATE_COLUMNS + S.FLIGHT_INT_COLUMNS


def _lookup_cells(raw: DataFrame, code_type: str) -> DataFrame:
    require_columns(raw.columns, S.LOOKUP_COLUMNS, "lookup")
    code = (
        cells.strict_integer(F.trim(F.col("Code"))) if code_type == "integer"
        else cells.code_text(F.col("Code"))
    )
    return raw.select(code.alias("Code"), F.trim(F.col("Description")).alias("Description"))


def clean_lookup(raw: DataFrame, code_type: str, code_name: str, description_name: str) -> DataFrame:
    """Typed lookup rows with a code and a non-empty description, one per code."""
    usable = _lookup_cells(raw, code_type).where(
        F.col("Code").isNotNull() & (F.col("Description") != "")
    )
    return dedup(usable, ["Code"], ["Description"]).withColumnsRenamed(
        {"Code": code_name, "Description": description_name}
    )


def lookup_report(raw: DataFrame, code_type: str) -> DataFrame:
    """``section, metric, value`` of a lookup: missing values, codes with several rows, result.

    Rows are first counted per code, so one pass and one small shuffle give every figure.
    """
    rows = _lookup_cells(raw, code_type)
    no_text = F.col("Description").isNull() | (F.col("Description") == "")
    per_code = rows.groupBy("Code").agg(
        F.count("*").alias("n"),
        F.count_if(no_text).alias("no_text"),
    )
    has_code = F.col("Code").isNotNull()
    total = per_code.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_rows"),
        F.coalesce(F.sum(F.when(~has_code, F.col("n"))), F.lit(0)).alias("missing_code"),
        F.coalesce(F.sum("no_text"), F.lit(0)).alias("missing_description"),
        F.count_if(has_code & (F.col("n") > 1)).alias("duplicate_codes"),
        F.count_if(has_code & (F.col("n") > F.col("no_text"))).alias("silver_rows"),
    ).withColumn("total_rejected", F.col("bronze_rows") - F.col("silver_rows"))
    metrics = ["bronze_rows", "missing_code", "missing_description", "duplicate_codes",
               "total_rejected", "silver_rows"]
    section = F.when(F.col("metric").isin("bronze_rows", "total_rejected", "silver_rows"), "result")
    return total.unpivot([], metrics, "metric", "value").select(
        section.otherwise("validation").alias("section"), "metric", "value"
    )


def clean_coordinates(raw: DataFrame) -> DataFrame:
    """Latest, in-range coordinates, one row per airport id."""
    require_columns(raw.columns, S.COORDINATE_COLUMNS, "airport_coordinates")
    placed = (
        raw.where(cells.strict_integer(F.col("AIRPORT_IS_LATEST")) == 1)
        .select(
            cells.strict_integer(F.col("AIRPORT_ID")).alias("AirportID"),
            cells.code_text(F.col("AIRPORT")).alias("AirportCode"),
            cells.plain_text(F.col("DISPLAY_AIRPORT_NAME")).alias("AirportName"),
            cells.plain_text(F.col("DISPLAY_AIRPORT_CITY_NAME_FULL")).alias("AirportCityName"),
            cells.plain_text(F.col("AIRPORT_STATE_NAME")).alias("AirportStateName"),
            F.col("LATITUDE").try_cast("double").alias("Latitude"),
            F.col("LONGITUDE").try_cast("double").alias("Longitude"),
        )
        .where(
            F.col("AirportID").isNotNull()
            & F.col("Latitude").between(-90, 90)
            & F.col("Longitude").between(-180, 180)
        )
    )
    return dedup(placed, ["AirportID"])
