"""Column expressions on short texts: flight numbers, registrations and event names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a flight number.
LEADING_LETTERS = r"^([A-Za-z]+)"
TRAILING_DIGITS = r"(\d+)$"


def carrier_prefix(number: Column, pattern: str = LEADING_LETTERS) -> Column:
    """Leading letters; ``''`` when there are none, null for null."""
    return F.regexp_extract(number, pattern, 1)


def strip_leading_zeros(text: Column) -> Column:
    return F.regexp_replace(text, r"^0+", "")


def strip_hyphens(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(""))


def plain_number(number: Column, pattern: str = TRAILING_DIGITS) -> Column:
    """Trailing digits without leading zeros; ``''`` when there are none, null for null."""
    return strip_leading_zeros(F.regexp_extract(number, pattern, 1))


def map_name(name: Column, names: Mapping[str, str]) -> Column:
    """Look a source name up in a fixed dictionary; null when it is not listed.

    The dictionary is a constant in the plan. One that is a table, or that grows, belongs in a join.
    """
    entries = [F.lit(part) for pair in names.items() for part in pair]
    return F.create_map(*entries)[name]
