"""Time texts as column expressions.

All text written here is UTC and needs a session pinned to UTC (``session.require_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyedflow.functions.binding import let, let_sql

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
DAY = "yyyy-MM-dd"

# What counts as surrounding white space: ASCII blanks and separators, next-line, no-break space.
WHITE_SPACE = " \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85\xa0"

# Spellings that Spark's own cast reads by the same rules as below.
COMMON_SPELLING = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[+-]\d{2}(?::?\d{2})?)?)?$"
)

# ISO 8601: a calendar, ordinal or week date, then optionally any one separator and a time of day
# in basic or extended form with an optional decimal fraction and offset. Plain numbers are left out.
# Groups: 1 date, 2 hour, 3 time separator, 4 minute, 5 second, 6 fraction, 7 offset.
ISO_SPELLING = (
    r"^(?!0000)(?!\d+$)"
    r"(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-\d{3}|\d{7}|\d{4}-W\d{2}-\d|\d{4}W\d{3}"
    r"|\d{4}-\d{2}(?=$)|\d{4}-?W\d{2}(?=$))"
    r"(?:[^0-9](?=..)(?:(\d{2})(?:(:?)(\d{2})(?:\3(\d{2})(?:[.,](\d+))?)?)?)?([Zz]|[+-]\d{2}(?::?\d{2})?)?)?$"
)
LEADING_DAY = r"^((?!0000)\d{4}-\d{1,2}-\d{1,2})(?:T|$)"


def lag_seconds(later: Column, earlier: Column) -> Column:
    """Whole seconds from one instant to another."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def trim_white(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


# From the groups of ISO_SPELLING (date, hour, minute, second, fraction, offset) to numbers.
ISO_PARTS = """
g -> named_struct(
  'date', replace(g[0], '-', ''),
  'hour', coalesce(try_cast(g[1] AS int), 0),
  'minute', coalesce(try_cast(g[2] AS int), 0),
  'second', coalesce(try_cast(g[3] AS int), 0),
  'micros', coalesce(try_cast(rpad(g[4], 6, '0') AS int), 0),
  'sign', if(startswith(g[5], '-'), -1, 1),
  'offset_hour', coalesce(try_cast(substring(g[5], 2, 2) AS int), 0),
  'offset_minute', coalesce(try_cast(substring(replace(g[5], ':', ''), 4, 2) AS int), 0))
"""

# The day a date without dashes names: by week (2025W524), by day of the year (2025359) or by month.
ISO_DAY = """
CASE
  WHEN contains(p.date, 'W') THEN
    CASE WHEN substring(p.date, 6, 2) BETWEEN '01' AND '53' AND rpad(substring(p.date, 8, 1), 1, '1') BETWEEN '1' AND '7'
    THEN date_add(
      trunc(make_date(int(left(p.date, 4)), 1, 4), 'week'),
      (int(substring(p.date, 6, 2)) - 1) * 7 + int(rpad(substring(p.date, 8, 1), 1, '1')) - 1) END
  WHEN length(p.date) = 7 THEN
    CASE WHEN int(right(p.date, 3)) BETWEEN 1 AND dayofyear(make_date(int(left(p.date, 4)), 12, 31))
    THEN date_add(make_date(int(left(p.date, 4)), 1, 1), int(right(p.date, 3)) - 1) END
  ELSE try_cast(
    concat_ws('-', left(p.date, 4), substring(p.date, 5, 2), rpad(substring(p.date, 7, 2), 2, '01')) AS date)
END
"""

# The instant of those numbers, null when one is out of range; 24:00 is the end of the day.
ISO_INSTANT = f"""
p -> CASE
  WHEN (p.hour < 24 OR (p.hour = 24 AND p.minute + p.second + p.micros = 0))
    AND p.minute < 60 AND p.second < 60 AND p.offset_hour < 24 AND p.offset_minute < 60
  THEN timestamp_micros(
    unix_date({ISO_DAY}) * 86400000000
    + ((p.hour - p.sign * p.offset_hour) * 60 + p.minute - p.sign * p.offset_minute) * 60000000L
    + p.second * 1000000L + p.micros)
END
"""


def _iso_instant(text: Column) -> Column:
    """Instant of a text that matches ``ISO_SPELLING``; no offset means UTC; null when out of range."""
    groups = F.split(F.regexp_replace(text, ISO_SPELLING, "$1|$2|$4|$5|$6|$7"), r"\|")
    return let_sql(let_sql(groups, ISO_PARTS), ISO_INSTANT)


def _four_digit_years(written: Column) -> Column:
    """The written form, or null when an offset has moved it out of the years 0001 to 9999."""
    return F.when((F.length(written) == 24) & ~F.startswith(written, F.lit("0000")), written)


def normalize_trimmed(text: Column) -> Column:
    """:func:`normalize_timestamp` for a text already without surrounding white space."""
    common = let(F.date_format(F.try_to_timestamp(text), ISO_MILLIS), _four_digit_years)
    other = let(F.date_format(_iso_instant(text), ISO_MILLIS), _four_digit_years)
    return F.coalesce(
        F.when(F.endswith(text, F.lit("Z")) & F.contains(text, F.lit("T")), text),
        F.when(text.rlike(COMMON_SPELLING), common),
        F.when(text.rlike(ISO_SPELLING), other),
        F.when((text != "") & (F.lower(text) != "null"), text),
    )


def normalize_timestamp(text: Column) -> Column:
    """Bring an ISO 8601 text to ``yyyy-MM-ddTHH:mm:ss.SSSZ`` in UTC.

    Null, blank and ``null`` give null. Numbers, texts already in Zulu form and texts that are no
    ISO time come back unchanged but for surrounding white space. Milliseconds are cut, not rounded.
    """
    return normalize_trimmed(trim_white(text))


def iso_text(instant: Column) -> Column:
    """The same text form for a timestamp column."""
    return F.date_format(instant, ISO_MILLIS)


def valid_date(text: Column) -> Column:
    """UTC day of a date or time text as ``yyyy-MM-dd``; null when it does not start with a real day."""
    day = F.regexp_extract(normalize_timestamp(text), LEADING_DAY, 1)
    return F.date_format(day.try_cast("date"), DAY)


def lenient_date(text: Column) -> Column:
    """UTC day of anything Spark reads as a timestamp, null otherwise.

    A bare time of day is refused: Spark would complete it with the current date.
    """
    bare_time = text.rlike(r"^\s*T?\d{1,2}:")
    return F.when(~bare_time, F.date_format(F.try_to_timestamp(text), DAY))
