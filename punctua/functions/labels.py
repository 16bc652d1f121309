"""Period and route labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_date(year: str = "year", month: str = "month") -> Column:
    return F.make_date(F.col(year), F.col(month), F.lit(1))


def period_ordinal(year: str = "year", month: str = "month") -> Column:
    return F.col(year) * 100 + F.col(month)


def period_label(year: str = "year", month: str = "month") -> Column:
    return F.format_string("%d-%02d", F.col(year), F.col(month))


def route_label(origin: str = "origin_airport_code", dest: str = "dest_airport_code") -> Column:
    """``A → B``; NULL when either code is NULL."""
    return F.concat(F.col(origin), F.lit(" → "), F.col(dest))


def _empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def place_label(city: str = "city", code: str = "airport_code") -> Column:
    """``City (CODE)``; a NULL city shows as empty, a NULL code makes the label NULL."""
    return F.concat(_empty(city), F.lit(" ("), F.col(code), F.lit(")"))


def display_route() -> Column:
    """``City (CODE) → City (CODE)`` with every NULL shown as empty."""
    return F.concat(
        _empty("origin_city"), F.lit(" ("), _empty("origin_airport_code"), F.lit(") → "),
        _empty("dest_city"), F.lit(" ("), _empty("dest_airport_code"), F.lit(")"),
    )


def cancel_diversion_rate() -> Column:
    return F.col("cancellation_rate_pct") + F.col("diversion_rate_pct")
