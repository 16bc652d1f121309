"""Star schema rows: airline and airport dimensions, fact projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.functions import cells
from punctua.operators.dedup import dedup


def build_dim_airline(lookup: DataFrame, last_colon: bool = False) -> DataFrame:
    """Airlines from cleaned lookup rows ``AirlineID, AirlineName`` shaped ``Name: CODE``."""
    name, code = cells.split_name_code(F.col("AirlineName"), last_colon)
    airlines = lookup.select(
        F.col("AirlineID").cast("int").alias("airline_id"),
        name.alias("airline_name"),
        code.alias("airline_code"),
    ).where(F.col("airline_id").isNotNull() & (F.col("airline_name") != ""))
    return dedup(airlines, ["airline_id"])


def route_ends(df: DataFrame, ends: list[dict[str, str]]) -> DataFrame:
    """Distinct rows of several column groups of one frame, from one scan.

    ``ends`` maps output names to input columns, once per group. ``distinct`` combines map-side,
    so what is shuffled is bounded by the distinct ends of each task, not by the rows.
    """
    groups = [F.struct(*[F.col(c).alias(name) for name, c in end.items()]) for end in ends]
    return df.select(F.inline(F.array(*groups))).distinct()


def build_dim_airport(flights: DataFrame, airport_ids: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Airports seen as origin or destination, with names and coordinates where known.

    ``airport_ids`` and ``coordinates`` are cleaned rows, which hold each id once.
    """
    ends = route_ends(flights, [
        {"airport_id": f"{end}AirportID", "airport_code": end,
         "city_label": f"{end}CityName", "state": f"{end}StateName"}
        for end in ("Origin", "Dest")
    ])
    city, state_code = cells.split_city_state(F.col("city_label"))
    base = dedup(
        ends.where("airport_id IS NOT NULL").select(
            F.col("airport_id").cast("int").alias("airport_id"), "airport_code",
            city.alias("city"), state_code.alias("state_code"), "state",
        ),
        ["airport_id"],
    )
    # The cleaned inputs hold each id once.
    names = airport_ids.select(
        F.col("AirportID").cast("int").alias("airport_id"),
        cells.airport_name(F.col("AirportName")).alias("airport_name"),
    )
    places = coordinates.select(
        F.col("AirportID").cast("int").alias("airport_id"),
        F.col("Latitude").cast("double").alias("latitude"),
        F.col("Longitude").cast("double").alias("longitude"),
    )
    return (
        base.join(names, "airport_id", "left").join(places, "airport_id", "left")
        .select(*S.DIM_AIRPORT.names)
    )


def build_fact(flights: DataFrame) -> DataFrame:
    """Fact columns from cleaned flight rows, by name; every number is an int."""
    return flights.select(*[
        (F.col(source) if name in ("flight_date", "dep_time_block") else F.col(source).cast("int"))
        .alias(name)
        for name, source in S.FACT_SOURCES.items()
    ])
