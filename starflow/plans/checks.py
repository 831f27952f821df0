"""Whether a refresh lost or made up rows on its way, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starflow.operators.audit import all_checks, fail_on_mismatch, keys_found, same_rows
from starflow.columns import TABLE_NAMES
from starflow.plans.refresh import RefreshConfig
from starflow.sources import read_parquet, warehouse_tables

# Each dimension's key, which facts carry under the same name.
DIMENSION_KEYS = {name: name.removeprefix("dim_").upper() + "_KEY" for name in TABLE_NAMES if name.startswith("dim_")}


def load_report(spark: SparkSession, config: RefreshConfig) -> DataFrame:
    """(check_name, expected, found): rows from bronze to facts, rows of each table from silver to gold to warehouse, and the
    keys of the warehouse's facts that its dimensions have."""
    bronze = read_parquet(spark, config.bronze_path)
    warehouse = warehouse_tables(spark, config.database)
    checks = [same_rows("bronze to silver: fact_events", bronze, read_parquet(spark, f"{config.silver_root}/fact_events"))]
    for name in TABLE_NAMES:
        silver = read_parquet(spark, f"{config.silver_root}/{name}")
        gold = read_parquet(spark, f"{config.gold_root}/{name}")
        checks.append(same_rows(f"silver to gold: {name}", silver, gold))
        checks.append(same_rows(f"gold to warehouse: {name}", gold, warehouse[name]))
    for name, key in DIMENSION_KEYS.items():
        checks.append(keys_found(f"keys: {name}", warehouse["fact_events"], warehouse[name], key))
    return all_checks(checks)


def verify(spark: SparkSession, config: RefreshConfig) -> None:
    """Fail where the report's numbers differ: a file was lost, a stage was run twice or on other data."""
    fail_on_mismatch(load_report(spark, config))
