"""Cleaned events to five dimensions and a fact table.

A dimension is one distinct over its own columns, combined before the single
shuffle; its key is computed afterwards, once per row that is left. The fact
table is a projection and shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starflow.columns import DEVICE_COLUMNS
from starflow.functions import (
    device_key,
    geo_key,
    page_key,
    session_id,
    session_key,
    user_id,
    user_key,
)
from starflow.operators import clean, distinct_rows, first_row_per_key
from starflow.sources import for_each_table, read_parquet, write_csv, write_parquet


def user_rows(events: DataFrame) -> DataFrame:
    """What dim_user reads of each event."""
    return events.select(
        "distinct_id", "person_id", user_id().alias("user_id"), "event_timestamp", "event_uuid"
    )


def first_users(rows: DataFrame) -> DataFrame:
    """The earliest of `user_rows` per distinct_id. First rows of parts have the same first rows
    as the whole, so the result is also a state to go on from."""
    return first_row_per_key(rows, ["distinct_id"], ["event_timestamp", "event_uuid"])


def as_dim_user(first: DataFrame) -> DataFrame:
    return first.select("distinct_id", "person_id", "user_id", user_key().alias("user_key"))


def dim_user(events: DataFrame) -> DataFrame:
    """One row per distinct_id, NULL included: that of its earliest event."""
    return as_dim_user(first_users(user_rows(events)))


def dim_device(events: DataFrame) -> DataFrame:
    devices = distinct_rows(events.select(*DEVICE_COLUMNS))
    return devices.withColumn("device_key", device_key())


def dim_geo(events: DataFrame) -> DataFrame:
    """Distinct (name, code) pairs; rows that share a code share a key."""
    places = distinct_rows(events.select("country_name", "country_code"))
    return places.withColumn("geo_key", geo_key())


def dim_session(events: DataFrame) -> DataFrame:
    sessions = distinct_rows(events.select(session_id().alias("session_id")))
    return sessions.withColumn("session_key", session_key(sessions["session_id"]))


def dim_page(events: DataFrame) -> DataFrame:
    """Distinct page views; rows that share host and path share a key."""
    pages = distinct_rows(events.select("pathname", "current_url", "host", "surface"))
    return pages.withColumn("page_key", page_key())


def fact_events(events: DataFrame) -> DataFrame:
    """Every event with the keys of its dimensions; events are not deduplicated."""
    return events.select(
        "event_uuid",
        "event_name",
        "event_timestamp",
        user_key().alias("user_key"),
        device_key().alias("device_key"),
        geo_key().alias("geo_key"),
        session_key().alias("session_key"),
        page_key().alias("page_key"),
    )


SILVER_TABLES = {
    "dim_user": dim_user,
    "dim_device": dim_device,
    "dim_geo": dim_geo,
    "dim_session": dim_session,
    "dim_page": dim_page,
    "fact_events": fact_events,
}


def silver_tables(events: DataFrame) -> dict[str, DataFrame]:
    return {name: table(events) for name, table in SILVER_TABLES.items()}


def build_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_root: str,
    concurrent: bool = True,
    zone: str = "UTC",
) -> None:
    """Write the silver tables from staged bronze.

    The six writes read the same Parquet, each only its own few columns. That
    is less than caching the union of those columns would write and read.
    """
    events = clean(read_parquet(spark, bronze_path), zone)
    for_each_table(
        spark,
        SILVER_TABLES,
        lambda name: write_parquet(SILVER_TABLES[name](events), f"{silver_root}/{name}"),
        concurrent,
    )


def export_silver(
    spark: SparkSession, silver_root: str, csv_root: str, concurrent: bool = True
) -> None:
    """Copy the silver tables to CSV, for readers that need it; gold is not built from it."""
    for_each_table(
        spark,
        SILVER_TABLES,
        lambda name: write_csv(
            read_parquet(spark, f"{silver_root}/{name}"), f"{csv_root}/{name}"
        ),
        concurrent,
    )
