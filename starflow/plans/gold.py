"""Silver to the published tables: upper-case names and keys, declared types.

Only projections. A dimension keeps silver's rows, so keys that silver repeats
are repeated here too.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.columns import GOLD_TABLES, TABLE_NAMES
from starflow.functions import as_text, at_zone, first_present, parse_timestamp, upper_text
from starflow.sources import for_each_table, read_parquet, write_parquet


def _instant(source: str, source_type: str, zone: str) -> Column:
    if source_type == "string":
        return parse_timestamp(source, zone)
    if source_type == "timestamp":
        return F.col(source)
    return at_zone(F.col(source).cast("timestamp_ntz"), zone)


def _published(table: str, name: str, type_name: str, source_type: str, zone: str) -> Column:
    source = name.lower()
    if (table, name) == ("dim_user", "USER_ID"):
        value = first_present("user_id", "distinct_id")
    elif name.endswith("_KEY"):
        value = upper_text(source)
    elif type_name == "timestamp":
        value = _instant(source, source_type, zone)
    else:
        value = as_text(source)
    return value.alias(name)


def gold_table(table: str, silver: DataFrame, zone: str = "UTC") -> DataFrame:
    """The published shape of one silver table; times without an offset are in `zone`."""
    source_types = dict(silver.dtypes)
    return silver.select(
        *[
            _published(table, name, type_name, source_types.get(name.lower(), "string"), zone)
            for name, type_name in GOLD_TABLES[table].items()
        ]
    )


def gold_tables(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {table: gold_table(table, silver[table]) for table in TABLE_NAMES}


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    concurrent: bool = True,
    zone: str = "UTC",
) -> None:
    """Write the gold tables from written silver."""

    def publish(name: str) -> None:
        gold = gold_table(name, read_parquet(spark, f"{silver_root}/{name}"), zone)
        write_parquet(gold, f"{gold_root}/{name}", compression="snappy")

    for_each_table(spark, TABLE_NAMES, publish, concurrent)
