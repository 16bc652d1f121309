"""Ratios rounded to two decimals, half away from zero, computed on integers.

Integer arithmetic makes the result independent of partitioning and task order, and the same
on every engine; a floating-point ``round`` can flip on exact halves.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_2dp(numerator: Column, denominator: Column, factor: int = 1) -> Column:
    """``round(factor * numerator / denominator, 2)``; NULL when the denominator is 0 or NULL."""
    den = F.nullif(denominator.cast("long"), F.lit(0).cast("long"))
    scaled = numerator.cast("long") * F.lit(200 * factor)
    magnitude = F.call_function("div", F.abs(scaled) + den, den * F.lit(2))
    return F.when(scaled < 0, -magnitude).otherwise(magnitude) / F.lit(100.0)


def percent_2dp(part: Column, whole: Column) -> Column:
    return ratio_2dp(part, whole, 100)
