"""The stages: raw export to bronze, bronze to silver, silver to gold, gold to warehouse."""

from starflow.plans.bronze import ingest_bronze
from starflow.plans.checks import load_report, verify
from starflow.plans.daily import advance_users, publish_day, run_day, users_over_days
from starflow.plans.gold import build_gold, gold_table, gold_tables
from starflow.plans.ledger import ChangedInput, run_once
from starflow.plans.refresh import RefreshConfig, run_refresh
from starflow.plans.silver import (
    SILVER_TABLES,
    build_silver,
    dim_device,
    dim_geo,
    dim_page,
    dim_session,
    dim_user,
    export_silver,
    fact_events,
    silver_tables,
)

__all__ = [
    "ChangedInput",
    "RefreshConfig",
    "SILVER_TABLES",
    "advance_users",
    "build_gold",
    "build_silver",
    "dim_device",
    "dim_geo",
    "dim_page",
    "dim_session",
    "dim_user",
    "export_silver",
    "fact_events",
    "gold_table",
    "gold_tables",
    "ingest_bronze",
    "load_report",
    "publish_day",
    "run_day",
    "run_once",
    "run_refresh",
    "silver_tables",
    "users_over_days",
    "verify",
]
