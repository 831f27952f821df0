"""Scalar helpers over built-in expressions, so plans stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(column: str | Column) -> Column:
    """The column as a string; Catalyst removes the cast where it is one already."""
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def upper_text(column: str | Column) -> Column:
    return F.upper(as_text(column))


def first_present(*columns: str | Column) -> Column:
    """First non-NULL value, compared as text.

    Casting first keeps mixed types legal under ANSI, where coalescing a number
    with a string raises.
    """
    return F.coalesce(*[as_text(c) for c in columns])


def or_default(column: str | Column, default: str) -> Column:
    """The column as text, with NULL replaced by a fixed string."""
    return F.coalesce(as_text(column), F.lit(default))


# Something after the time of day: an offset or the name of a zone. Possessive, so that a match never backtracks.
_ZONED = r"[T ]\s*+\d{1,2}+(?::\d{1,2}+){0,2}+(?:\.\d*+)?+\s*+[A-Za-z+-].*$"


def at_zone(local: Column, zone: str) -> Column:
    """The instant of a local date and time in a zone, whatever the session's zone is.

    A time that the zone skips is moved on by what it skips; one it has twice is the first.
    """
    # By what has passed since 1970, and not by year, month and so on: an expression named six times is computed six times.
    passed = (local - F.expr("TIMESTAMP_NTZ'1970-01-01'")).cast("interval second").cast("decimal(20,6)")
    return F.to_utc_timestamp(F.timestamp_seconds(passed), zone)


def parse_timestamp(column: str | Column, zone: str = "UTC") -> Column:
    """Timestamp from text, NULL where the text is not one.

    Reads an offset or a zone if there is one, and `zone` otherwise; the session's zone
    plays no part.
    """
    text = as_text(column)
    local = at_zone(text.try_cast("timestamp_ntz"), zone)
    return F.when(text.rlike(_ZONED), F.try_to_timestamp(text)).otherwise(local)


def declared(column: str | Column, type_name: str, zone: str = "UTC") -> Column:
    """Text as a declared type, NULL where it does not parse."""
    if type_name == "timestamp":
        return parse_timestamp(column, zone)
    return as_text(column).try_cast(type_name)
