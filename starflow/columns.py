"""Names and types of the clickstream model, from raw export to warehouse."""

from __future__ import annotations

# Raw export columns that no later table uses.
UNUSED_COLUMNS = (
    "Unnamed: 0",
    "_inserted_at",
    "prop_$config_defaults",
    "prop_$is_identified",
    "prop_$web_vitals_enabled_server_side",
    "prop_$dead_clicks_enabled_server_side",
    "prop_$timezone_offset",
    "prop_$lib",
    "prop_$timezone",
    "prop_$insert_id",
    "prop_$time",
    "prop_$console_log_recording_enabled_server_side",
    "prop_$session_recording_start_reason",
    "prop_$raw_user_agent",
    "prop_$lib_version",
    "prop_$sent_at",
)

# Raw export column -> model column.
COLUMN_NAMES = {
    "uuid": "event_uuid",
    "event": "event_name",
    "timestamp": "event_timestamp",
    "prop_$user_id": "posthog_user_id",
    "prop_userId": "app_user_id",
    "prop_user_id": "prop_user_id",
    "prop_$session_id": "session_id",
    "prop_session_id": "prop_session_id",
    "prop_$pathname": "pathname",
    "prop_$current_url": "current_url",
    "prop_$host": "host",
    "prop_surface": "surface",
    "prop_$device_type": "device_type",
    "prop_$browser": "browser",
    "prop_$browser_version": "browser_version",
    "prop_$os": "os",
    "prop_$os_version": "os_version",
    "prop_$browser_language": "browser_language",
    "prop_$geoip_country_name": "country_name",
    "prop_$geoip_country_code": "country_code",
    "prop_$viewport_width": "viewport_width",
    "prop_$viewport_height": "viewport_height",
    "prop_$screen_width": "screen_width",
    "prop_$screen_height": "screen_height",
    "prop_$referrer": "referrer",
    "prop_$referring_domain": "referring_domain",
    "prop_tool_name": "tool_name",
    "prop_credit_amount": "credit_amount",
    "prop_credits_used": "credits_used",
}

# Model columns that are not text. Everything else, every key input above all,
# stays the text that was exported: "007" and "17.10" must hash as written.
DECLARED_TYPES = {
    "event_timestamp": "timestamp",
    "viewport_width": "int",
    "viewport_height": "int",
    "screen_width": "int",
    "screen_height": "int",
    "credit_amount": "double",
    "credits_used": "double",
}

# User ids and session ids in order of preference.
USER_ID_COLUMNS = ("posthog_user_id", "app_user_id", "prop_user_id")
SESSION_ID_COLUMNS = ("session_id", "prop_session_id")

# Natural keys, in hashing order.
DEVICE_COLUMNS = (
    "device_type",
    "browser",
    "browser_version",
    "os",
    "os_version",
    "browser_language",
)
PAGE_KEY_COLUMNS = ("host", "pathname")

# Columns each silver table needs from the cleaned events.
SILVER_INPUTS = {
    "dim_user": ("distinct_id", "person_id", *USER_ID_COLUMNS, "event_timestamp", "event_uuid"),
    "dim_device": DEVICE_COLUMNS,
    "dim_geo": ("country_name", "country_code"),
    "dim_session": SESSION_ID_COLUMNS,
    "dim_page": ("pathname", "current_url", "host", "surface"),
    "fact_events": (
        "event_uuid",
        "event_name",
        "event_timestamp",
        "distinct_id",
        *DEVICE_COLUMNS,
        "country_code",
        *SESSION_ID_COLUMNS,
        *PAGE_KEY_COLUMNS,
    ),
}

# Published tables, their columns in order, and their types.
GOLD_TABLES = {
    "dim_user": {
        "USER_KEY": "string",
        "DISTINCT_ID": "string",
        "PERSON_ID": "string",
        "USER_ID": "string",
    },
    "dim_device": {"DEVICE_KEY": "string", "BROWSER": "string", "OS": "string"},
    "dim_geo": {"GEO_KEY": "string", "COUNTRY_CODE": "string"},
    "dim_session": {"SESSION_KEY": "string", "SESSION_ID": "string"},
    "dim_page": {"PAGE_KEY": "string", "PATHNAME": "string"},
    "fact_events": {
        "EVENT_UUID": "string",
        "EVENT_NAME": "string",
        "EVENT_TIMESTAMP": "timestamp",
        "USER_KEY": "string",
        "DEVICE_KEY": "string",
        "GEO_KEY": "string",
        "SESSION_KEY": "string",
        "PAGE_KEY": "string",
    },
}

TABLE_NAMES = tuple(GOLD_TABLES)
