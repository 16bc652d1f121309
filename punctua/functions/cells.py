"""Lenient typing and text cleaning of raw cells.

A malformed cell becomes NULL (and is counted by the validation report); it never aborts a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label shapes "City, ST", "Name: CODE" and "City, ST: Airport name".
# \z rather than $ in the first one: Java's $ would also accept a trailing newline.
CITY_STATE = r"^(.*),\s*([A-Z]{2})\z"
NAME_BEFORE_FIRST_COLON = r"^(.*?):"
CODE_AFTER_FIRST_COLON = r":\s*([A-Za-z0-9]+)"
NAME_BEFORE_LAST_COLON = r"^(.*):"
CODE_AFTER_LAST_COLON = r":\s*([A-Za-z0-9]+)[^:]*\z"
NAME_OF_PLACE = r"^.+,[^:]+:\s*(.+)$"


def whole_number(cell: Column) -> Column:
    """Text such as ``12``, ``0815`` or ``-3.00`` to int, truncating toward zero."""
    return cell.try_cast("double").try_cast("int")


def strict_integer(cell: Column) -> Column:
    """Text to int for codes, where ``12.00`` is malformed."""
    return cell.try_cast("int")


def calendar_date(cell: Column) -> Column:
    return F.try_to_date(cell)


def plain_text(cell: Column) -> Column:
    return F.trim(cell)


def code_text(cell: Column) -> Column:
    return F.upper(F.trim(cell))


def is_malformed(raw: Column, typed: Column) -> Column:
    """A cell that had content but did not survive its cast."""
    return (F.trim(raw) != "") & typed.isNull()


def split_city_state(label: Column) -> tuple[Column, Column]:
    """``"City, ST"`` to (city, state code); both ``''`` when the shape does not match."""
    return (
        F.trim(F.regexp_extract(label, CITY_STATE, 1)),
        F.trim(F.regexp_extract(label, CITY_STATE, 2)),
    )


def split_name_code(label: Column, last_colon: bool = False) -> tuple[Column, Column]:
    """``"Name: CODE"`` to (name, code).

    By default both parts hang on the first colon, so ``"A: B: C"`` gives (``A``, ``B``);
    ``last_colon=True`` splits at the last one and gives (``A: B``, ``C``).
    """
    before, after = (
        (NAME_BEFORE_LAST_COLON, CODE_AFTER_LAST_COLON) if last_colon
        else (NAME_BEFORE_FIRST_COLON, CODE_AFTER_FIRST_COLON)
    )
    return (
        F.trim(F.regexp_extract(label, before, 1)),
        F.upper(F.regexp_extract(label, after, 1)),
    )


def airport_name(label: Column) -> Column:
    """``"City, ST: Airport name"`` to the airport name."""
    return F.trim(F.regexp_extract(label, NAME_OF_PLACE, 1))
