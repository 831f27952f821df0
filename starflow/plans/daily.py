"""The refresh by execution date: each date's export replaces that date, and nothing else.

A date has its own bronze folder, its own facts, and for each dimension what the date alone
says: its distinct rows, or its first event of each user. These are small, and merging
them gives the dimensions of all dates, whichever dates were loaded, in whatever order and how
often. Facts of other dates are neither read nor written. All tables are published together.
"""

from __future__ import annotations

import logging
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from starflow.columns import SILVER_INPUTS
from starflow.operators import clean, distinct_rows, table_counts
from starflow.plans.bronze import ingest_bronze
from starflow.plans.gold import gold_table
from starflow.plans.refresh import RefreshConfig
from starflow.plans.silver import SILVER_TABLES, as_dim_user, first_users, user_rows
from starflow.sources import (
    create_snapshots,
    for_each_table,
    load_parts,
    published_tables,
    read_parquet,
    write_parquet,
)

log = logging.getLogger(__name__)

FACTS = "fact_events"
DIMENSIONS = tuple(name for name in SILVER_TABLES if name != FACTS)
_DATE = re.compile(r"\d{8}|\d{4}-\d{2}-\d{2}")


def day_rows(name: str, events: DataFrame) -> DataFrame:
    """What a day's events say about a dimension, in a form that merges."""
    if name == "dim_user":
        return first_users(user_rows(events))
    return distinct_rows(events.select(*SILVER_INPUTS[name]))


def merged_dimension(name: str, days: DataFrame) -> DataFrame:
    """The silver dimension of all days, from the rows of `day_rows` of each."""
    if name == "dim_user":
        return as_dim_user(first_users(days))
    return SILVER_TABLES[name](days)


def advance_users(state: DataFrame | None, events: DataFrame) -> DataFrame:
    """The first events of users up to now, from those before (None: none) and a day's events.

    Where days are only ever added, this alone keeps dim_user (`as_dim_user` of the state): a day costs its events and one row a
    user. The caller writes the state. Events may come in any order, and again: an earlier event replaces a later one. Events
    that a day is to lose need `run_day`.
    """
    rows = user_rows(events)
    return first_users(rows if state is None else state.unionByName(rows))


def _date(date: str) -> str:
    """20250901 and 2025-09-01 are the same date."""
    if not _DATE.fullmatch(date):
        raise ValueError(f"not an execution date: {date!r}")
    plain = date.replace("-", "")
    return f"{plain[:4]}-{plain[4:6]}-{plain[6:]}"


def ingest_day(spark: SparkSession, config: RefreshConfig, date: str, raw_path: str | list[str]) -> None:
    """Replace a date's bronze and what it says about the dimensions."""
    bronze = f"{config.lake_root}/daily/bronze/date={_date(date)}"
    ingest_bronze(
        spark, raw_path, bronze, config.reading, config.check_headers, config.spread, config.max_records_per_file
    )
    events = clean(read_parquet(spark, bronze), config.time_zone)
    for_each_table(
        spark,
        DIMENSIONS,
        lambda name: write_parquet(
            day_rows(name, events), f"{config.lake_root}/daily/{name}/date={_date(date)}"
        ),
        config.concurrent,
    )


def publish_day(spark: SparkSession, config: RefreshConfig, date: str) -> None:
    """Publish a date's facts in place of those it had, with the dimensions of all dates."""
    date, zone = _date(date), config.time_zone
    events = clean(read_parquet(spark, f"{config.lake_root}/daily/bronze/date={date}"), zone)
    tables = {FACTS: gold_table(FACTS, SILVER_TABLES[FACTS](events), zone)}
    for name in DIMENSIONS:
        days = read_parquet(spark, f"{config.lake_root}/daily/{name}").drop("date")
        tables[name] = gold_table(name, merged_dimension(name, days), zone)
    create_snapshots(spark, config.database, config.database_location)
    parts = load_parts(spark, config.database, tables, {FACTS: date}, config.concurrent)
    log.info("published %s: facts of %d dates", date, sum(p.table == FACTS for p in parts))


def run_day(spark: SparkSession, config: RefreshConfig, date: str, raw_path: str | list[str]) -> DataFrame:
    """Load one execution date and return the rows per published table.

    Repeatable: the same export again changes nothing, another export for the date replaces the first. A run that fails
    leaves what is published as it was, and is run again. One run at a time.
    """
    ingest_day(spark, config, date, raw_path)
    publish_day(spark, config, date)
    return table_counts(published_tables(spark, config.database))


def users_over_days(days: list[DataFrame], keep) -> DataFrame:
    """dim_user after all days, by `advance_users`; `keep` writes a state and reads it back."""
    return as_dim_user(reduce(lambda state, events: keep(advance_users(state, events)), days, None))
