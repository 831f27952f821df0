"""Surrogate keys: the first 64 bits of an MD5, as 16 hex characters.

A dimension and the fact table hash the same natural key, so neither needs a
join to find the other. Each key is defined once here and used on both sides.
Adding a key to a fact row costs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starflow.columns import (
    DEVICE_COLUMNS,
    PAGE_KEY_COLUMNS,
    SESSION_ID_COLUMNS,
    USER_ID_COLUMNS,
)
from starflow.functions.scalars import as_text, first_present, or_default

# Part of every stored key.
KEY_LENGTH = 16
SEPARATOR = "|"
NO_COUNTRY = "UNKNOWN"
NO_SESSION = "null"


def digest_key(text: Column) -> Column:
    return F.substring(F.md5(text), 1, KEY_LENGTH)


def piped_text(*columns: str | Column) -> Column:
    """Several parts as one text. NULL counts as '', since concat_ws would skip it."""
    return F.concat_ws(SEPARATOR, *[or_default(c, "") for c in columns])


def piped_key(*columns: str | Column) -> Column:
    """Key of several parts."""
    return digest_key(piped_text(*columns))


def key_texts() -> dict[str, Column]:
    """What each of the five keys hashes."""
    return {
        "user_key": as_text("distinct_id"),
        "device_key": piped_text(*DEVICE_COLUMNS),
        "geo_key": or_default("country_code", NO_COUNTRY),
        "session_key": or_default(session_id(), NO_SESSION),
        "page_key": piped_text(*PAGE_KEY_COLUMNS),
    }


def user_id() -> Column:
    return first_present(*USER_ID_COLUMNS)


def session_id() -> Column:
    return first_present(*SESSION_ID_COLUMNS)


def user_key() -> Column:
    """NULL for a NULL distinct_id, so such events match no user."""
    return digest_key(as_text("distinct_id"))


def device_key() -> Column:
    return piped_key(*DEVICE_COLUMNS)


def geo_key() -> Column:
    """Hashes the code alone, so a key repeats where one code has several names."""
    return digest_key(or_default("country_code", NO_COUNTRY))


def session_key(session: Column | None = None) -> Column:
    return digest_key(or_default(session_id() if session is None else session, NO_SESSION))


def page_key() -> Column:
    """Hashes host and path, so a key repeats across the URLs and surfaces of a page."""
    return piped_key(*PAGE_KEY_COLUMNS)
