"""Three-band classification of KPI values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metric -> (higher is better, bound of the best band, bound of the middle band).
BANDS = {
    "on_time": (True, 80.0, 70.0),
    "delay": (False, 15.0, 25.0),
    "cancellation": (False, 1.0, 3.0),
    "diversion": (False, 0.5, 1.0),
}
GOOD, MIDDLE, BAD = "green", "gold", "red"


def reliability_band(value: Column, metric: str) -> Column:
    """Band of a KPI value; NULL and NaN fall into the worst band, unknown metrics into the middle."""
    if metric not in BANDS:
        return F.lit(MIDDLE)
    higher_is_better, best, middle = BANDS[metric]
    # NaN compares greater than every number in Spark, so it is treated as missing first.
    known = F.when(~F.isnan(value.cast("double")), value.cast("double"))
    if higher_is_better:
        return F.when(known >= best, GOOD).when(known >= middle, MIDDLE).otherwise(BAD)
    return F.when(known <= best, GOOD).when(known <= middle, MIDDLE).otherwise(BAD)
