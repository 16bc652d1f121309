"""Monthly KPI series of entities together with the series of all entities."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.functions.labels import cancel_diversion_rate, period_date
from punctua.operators.reaggregate import aggregate_periods, select_entities


def all_entities_series(monthly: DataFrame, weighted_columns: list[str], labels: dict[str, str | None]) -> DataFrame:
    """The combined KPI of all entities per month, labelled like an entity."""
    series = aggregate_periods(monthly, ["year", "month"], weighted_columns)
    return series.withColumns({name: F.lit(value).cast("string") for name, value in labels.items()})


def kpi_trend(
    monthly: DataFrame, entity: str, weighted_columns: list[str], total_label: str,
    selected: Iterable[str] | DataFrame | None = None,
) -> DataFrame:
    """Long trend table ``period, <entity>, is_total, flights, metric, value``.

    Metrics are the weighted columns plus ``cancel_diversion_rate_pct`` when its parts are there;
    missing values stay as rows with NULL.
    """
    total = all_entities_series(monthly, weighted_columns, {entity: total_label})
    rows = monthly if selected is None else select_entities(monthly, entity, selected)
    series = (
        total.withColumn("is_total", F.lit(True))
        .unionByName(rows.withColumn("is_total", F.lit(False)), allowMissingColumns=True)
    )
    metrics = list(weighted_columns)
    if {"cancellation_rate_pct", "diversion_rate_pct"} <= set(series.columns):
        series = series.withColumn("cancel_diversion_rate_pct", cancel_diversion_rate())
        metrics.append("cancel_diversion_rate_pct")
    return (
        series.withColumn("period", period_date())
        .unpivot(["period", entity, "is_total", "flights"], metrics, "metric", "value")
    )
