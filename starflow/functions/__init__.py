"""Column functions: each takes columns and returns a column."""

from starflow.functions.keys import (
    device_key,
    digest_key,
    geo_key,
    key_texts,
    page_key,
    piped_key,
    piped_text,
    session_id,
    session_key,
    user_id,
    user_key,
)
from starflow.functions.scalars import (
    as_text,
    at_zone,
    declared,
    first_present,
    or_default,
    parse_timestamp,
    upper_text,
)

__all__ = [
    "as_text",
    "at_zone",
    "declared",
    "device_key",
    "digest_key",
    "first_present",
    "geo_key",
    "key_texts",
    "or_default",
    "page_key",
    "parse_timestamp",
    "piped_key",
    "piped_text",
    "session_id",
    "session_key",
    "upper_text",
    "user_id",
    "user_key",
]
