"""Map preparation: coordinates, marker sizes, line widths, distinct route ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.operators.dedup import dedup

# Marker size is flights / max * 30 + 8; line width runs from 1 to 4 on a square-root
# scale and is 3 when all routes have the same number of flights.
MARKER_SPAN, MARKER_LEAST = 30, 8
WIDTH_LEAST, WIDTH_SPAN, WIDTH_EQUAL = 1.0, 3.0, 3.0


def airport_coordinates(kpi: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """KPI rows with the latitude and longitude of their airport, NULL when unknown."""
    return kpi.join(dim_airport.select("airport_id", "latitude", "longitude"), "airport_id", "left")


def route_coordinates(kpi: DataFrame, dim_airport: DataFrame) -> DataFrame:
    for role in ("origin", "dest"):
        place = dim_airport.select(
            *[F.col(c).alias(f"{role}_{c}") for c in ("airport_id", "latitude", "longitude")]
        )
        kpi = kpi.join(place, f"{role}_airport_id", "left")
    return kpi


def with_known_coordinates(df: DataFrame) -> DataFrame:
    """Rows whose every latitude and longitude column is filled."""
    return df.dropna(subset=[c for c in df.columns if c.endswith(("latitude", "longitude"))])


def route_end_points(routes: DataFrame, order: list[str]) -> DataFrame:
    """One point ``code, name, lat, lon`` per airport code of the shown routes.

    An airport seen several times keeps its last appearance, with the routes listed in descending
    ``order`` and the destination after the origin of the same route.
    """
    points = F.inline(F.array(*[
        F.struct(
            F.col(f"{role}_airport_code").alias("code"),
            F.col(f"{role}_airport_name").alias("name"),
            F.col(f"{role}_latitude").alias("lat"),
            F.col(f"{role}_longitude").alias("lon"),
            F.lit(place).alias("_place"),
        )
        for place, role in enumerate(("origin", "dest"))
    ]))
    seen = routes.select(*[F.col(c).alias(f"_by_{c}") for c in order], points)
    last_first = [F.asc_nulls_first(f"_by_{c}") for c in order] + [F.desc("_place")]
    return dedup(seen, ["code"], last_first).select("code", "name", "lat", "lon")


def marker_size(df: DataFrame, column: str = "marker_size") -> DataFrame:
    """Marker size, linear in flights."""
    most = df.agg(F.max("flights")).scalar()
    size = F.when(most > 0, F.col("flights") / most * MARKER_SPAN + MARKER_LEAST)
    return df.withColumn(column, size.otherwise(F.lit(float(MARKER_LEAST))))


def line_width(df: DataFrame, column: str = "line_width") -> DataFrame:
    """Line width, linear in the square root of flights between the least and the most."""
    least = df.agg(F.min("flights")).scalar()
    most = df.agg(F.max("flights")).scalar()
    share = (F.sqrt("flights") - F.sqrt(least)) / (F.sqrt(most) - F.sqrt(least))
    return df.withColumn(
        column, F.when(most == least, WIDTH_EQUAL).otherwise(F.lit(WIDTH_LEAST) + share * WIDTH_SPAN)
    )


def route_options(routes: DataFrame, role: str) -> DataFrame:
    """Distinct ends of routes in a role (``origin`` or ``dest``), one row per code, unsorted."""
    columns = [f"{role}_{c}" for c in ("airport_code", "airport_name", "city", "state_code")]
    known = routes.select(*columns).where(F.col(columns[0]).isNotNull()).distinct()
    return dedup(known, [columns[0]])
