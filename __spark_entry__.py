
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starflow.columns import GOLD_TABLES, TABLE_NAMES  # noqa: E402
from starflow.functions import (  # noqa: E402
    as_text,
    or_default,
    parse_timestamp,
    upper_text,
    user_id,
    user_key,
)
from starflow.operators import (  # noqa: E402
    cast_declared,
    cast_rescuing,
    distinct_rows,
    drop_columns,
    first_row_per_key,
    key_collisions,
    rename_columns,
    rescued_values,
    row_count,
    table_counts,
)
from starflow.plans import (  # noqa: E402
    SILVER_TABLES,
    RefreshConfig,
    gold_table,
    gold_tables,
    ingest_bronze,
    load_report,
    run_day,
    run_once,
    run_refresh,
    silver_tables,
    users_over_days,
)
from starflow.plans.refresh import STAGES  # noqa: E402
from starflow.plans.silver import dim_page, fact_events  # noqa: E402
from starflow.sample_clicks import bronze_view, raw_export, table  # noqa: E402
from starflow.sources import (  # noqa: E402
    create_snapshots,
    create_tables,
    for_each_table,
    load_parts,
    load_table,
    published_tables,
    read_csv,
    read_parquet,
    scratch_path,
    table_name,
    truncate_table,
    warehouse_tables,
    write_csv,
    write_parquet,
)

try:  # the operators for training text may be left out; the rest does not need them
    import starflow.llm.queries as llm
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "starflow.llm", "starflow.llm.queries"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
EVENT_TYPES = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "value": "double",
}


def entry(spark: SparkSession) -> DataFrame:
    """A whole refresh, from raw CSV to warehouse tables; returns the rows per table."""
    return refresh_counts(spark, SMOKE_DIR)


# ---------------------------------------------------------------------------
# Sources and sinks. Each writes to a fresh folder and returns what it reads back.


def _as_zoneless(df: DataFrame) -> DataFrame:
    """Published timestamps without a zone, the type the oracle's have."""
    return df.withColumn("EVENT_TIMESTAMP", _utc(F.col("EVENT_TIMESTAMP")))


def _utc(instant: Column) -> Column:
    """An instant as date and time in UTC, in any session's zone."""
    micros = F.timestamp_diff("MICROSECOND", F.timestamp_seconds(F.lit(0)), instant)
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01").cast("timestamp_ntz"))


def _events_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "events-csv")
    write_csv(table(spark, sf_dir, "events"), path)
    return path


def csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_csv(spark, _events_csv(spark, sf_dir))
    return cast_declared(raw, EVENT_TYPES)


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean export, whose lines are checked and which is then read split."""
    bronze = ingest_bronze(spark, _events_csv(spark, sf_dir), scratch_path(spark, "bronze"))
    return cast_declared(bronze, EVENT_TYPES)


def bronze_ingest_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same export read file by file, as one with line breaks in fields has to be."""
    bronze = ingest_bronze(
        spark, _events_csv(spark, sf_dir), scratch_path(spark, "bronze"), "whole", spread=True
    )
    return cast_declared(bronze, EVENT_TYPES)


# A field of several lines, with quotes and a separator.
NOTE_SQL = """concat('line 1 of ', CAST(event_id AS STRING), chr(10), 'say "', event_type, '", bye', chr(10))"""


def bronze_ingest_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export whose every record spans lines, read by records: files are split all the same."""
    path = scratch_path(spark, "notes-csv")
    write_csv(table(spark, sf_dir, "events").withColumn("note", F.expr(NOTE_SQL)), path)
    bronze = ingest_bronze(spark, path, scratch_path(spark, "bronze"), "records")
    return cast_declared(bronze, EVENT_TYPES)


def silver_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver-csv")
    write_csv(dim_page(bronze_view(spark, sf_dir)), path)
    return read_csv(spark, path, keep_empty=True)


def silver_csv_export_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver-csv")
    write_csv(fact_events(bronze_view(spark, sf_dir)), path)
    exported = read_csv(spark, path, keep_empty=True)
    return cast_declared(exported, {"event_timestamp": "timestamp_ntz"})


def _staged(df: DataFrame, label: str) -> DataFrame:
    """Written once and read back, for queries that would otherwise compute it again."""
    path = scratch_path(df.sparkSession, label)
    write_parquet(df, path)
    return read_parquet(df.sparkSession, path)


def silver_parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(fact_events(bronze_view(spark, sf_dir)), "silver")


def gold_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold")
    silver = fact_events(bronze_view(spark, sf_dir))
    write_parquet(gold_table("fact_events", silver), path, compression="snappy")
    return _as_zoneless(read_parquet(spark, path, "*.parquet"))


def _fresh_warehouse(spark: SparkSession) -> str:
    """An empty warehouse in a database of its own; the session may hold earlier ones."""
    location = scratch_path(spark, "warehouse")
    database = "starflow_" + location.rsplit("-", 1)[1]
    create_tables(spark, database, location)
    return database


def warehouse_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and rows of each table after create, load, and a second create."""
    database = _fresh_warehouse(spark)
    gold = gold_tables(silver_tables(_staged(bronze_view(spark, sf_dir), "bronze")))
    for_each_table(spark, gold, lambda name: load_table(spark, database, name, gold[name]))
    create_tables(spark, database)
    tables = warehouse_tables(spark, database)
    columns = F.create_map(
        *[F.lit(x) for name, df in tables.items() for x in (name, ",".join(df.columns))]
    )
    return table_counts(tables).withColumn("column_names", columns[F.col("table_name")])


def warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice, the second time with lower-case columns in another order."""
    database = _fresh_warehouse(spark)
    rows = _staged(gold_table("dim_page", dim_page(bronze_view(spark, sf_dir))), "gold")
    load_table(spark, database, "dim_page", rows)
    reordered = rows.selectExpr("PATHNAME AS pathname", "PAGE_KEY AS page_key")
    load_table(spark, database, "dim_page", reordered)
    return warehouse_tables(spark, database)["dim_page"]


def warehouse_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the fact table when loaded, when emptied, and when loaded again."""
    database = _fresh_warehouse(spark)
    rows = _staged(gold_table("fact_events", fact_events(bronze_view(spark, sf_dir))), "gold")
    target = table_name(database, "fact_events")
    load_table(spark, database, "fact_events", rows)
    loaded = spark.table(target).count()
    truncate_table(spark, database, "fact_events")
    emptied = spark.table(target).count()
    load_table(spark, database, "fact_events", rows)
    return row_count(spark.table(target)).select(
        F.lit(loaded).cast("bigint").alias("loaded"),
        F.lit(emptied).cast("bigint").alias("emptied"),
        F.col("n").alias("reloaded"),
    )


def _refresh(spark: SparkSession, sf_dir: str) -> tuple[RefreshConfig, DataFrame]:
    root = scratch_path(spark, "refresh")
    write_csv(raw_export(spark, sf_dir), f"{root}/raw")
    config = RefreshConfig(
        raw_path=f"{root}/raw",
        lake_root=f"{root}/lake",
        database="starflow_" + root.rsplit("-", 1)[1],
        database_location=f"{root}/warehouse",
    )
    return config, run_refresh(spark, config)


def refresh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per warehouse table after a refresh from raw CSV."""
    return _refresh(spark, sf_dir)[1]


def refresh_fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse fact table after a refresh from raw CSV."""
    config, _ = _refresh(spark, sf_dir)
    return _as_zoneless(warehouse_tables(spark, config.database)["fact_events"])


def refresh_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check of a refresh from raw CSV: what was expected and what was found."""
    config, _ = _refresh(spark, sf_dir)
    return load_report(spark, config)


def refresh_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per warehouse table after a refresh that stopped after silver and was taken up again."""
    root = scratch_path(spark, "resumed")
    write_csv(raw_export(spark, sf_dir), f"{root}/raw")
    config = RefreshConfig(f"{root}/raw", f"{root}/lake", "starflow_" + root.rsplit("-", 1)[1], f"{root}/warehouse")

    def stop(spark: SparkSession, config: RefreshConfig) -> None:
        raise InterruptedError

    try:
        run_once(spark, config, "first", {**STAGES, "gold": stop})
    except InterruptedError:
        pass
    return run_once(spark, config, "first")


# Characters of a key in the audit below: few enough for keys to collide.
SHORT_KEY = 3


def key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural keys that would share a key if keys were much shorter."""
    return key_collisions(bronze_view(spark, sf_dir), SHORT_KEY)


# Some values of events as text that does not parse.
GARBAGE_SQL = {
    "ts": "CASE WHEN event_id % 97 = 0 THEN concat('n/a ', CAST(event_id AS STRING)) ELSE '2024-01-01 00:00:00' END",
    "value": "CASE WHEN event_id % 89 = 0 THEN '12,5' WHEN event_id % 83 = 0 THEN '  ' ELSE '1.5' END",
}


def csv_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of an export that are not of their declared type, with the event and column they are from."""
    path = scratch_path(spark, "garbage-csv")
    garbled = {name: F.expr(sql) for name, sql in GARBAGE_SQL.items()}
    write_csv(table(spark, sf_dir, "events").withColumns(garbled), path)
    return rescued_values(cast_rescuing(read_csv(spark, path), EVENT_TYPES), ["event_id"])


def snapshot_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after all six were published together, twice."""
    root = scratch_path(spark, "snapshots")
    database = "starflow_" + root.rsplit("-", 1)[1]
    create_snapshots(spark, database, root)
    gold = gold_tables(silver_tables(_staged(bronze_view(spark, sf_dir), "bronze")))
    for _ in range(2):
        load_parts(spark, database, gold)
    return table_counts(published_tables(spark, database))


# The days of a month, dealt to three execution dates.
_THIRDS = {"2025-09-01": "BETWEEN 1 AND 10", "2025-09-02": "BETWEEN 11 AND 20", "2025-09-03": "> 20"}


def _daily(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The published tables after the export came by date: out of order, and one date twice."""
    root = scratch_path(spark, "daily")
    config = RefreshConfig("", f"{root}/lake", "starflow_" + root.rsplit("-", 1)[1], f"{root}/warehouse")
    export = raw_export(spark, sf_dir)
    for date in _THIRDS:  # a header, so that a date without events has a file too
        write_csv(export.limit(0), f"{root}/raw/date={date}")
    dates = " ".join(f"WHEN day(timestamp) {days} THEN '{date}'" for date, days in _THIRDS.items())
    dealt = export.withColumn("date", F.expr(f"CASE {dates} END")).filter("date IS NOT NULL")
    write_csv(dealt, f"{root}/raw", ["date"], add=True)
    for date in ("2025-09-02", "2025-09-03", "2025-09-01", "2025-09-02"):
        run_day(spark, config, date, f"{root}/raw/date={date}")
    return published_tables(spark, config.database)


def daily_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts(_daily(spark, sf_dir))


def daily_dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir)["dim_user"]


def silver_dim_user_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension from a state kept from day to day, the days out of order."""
    events = _staged(bronze_view(spark, sf_dir), "bronze")
    days = [events.filter(f"day(event_timestamp) {d}") for d in reversed(_THIRDS.values())]
    return users_over_days(days, lambda state: _staged(state, "users"))


# ---------------------------------------------------------------------------
# Single operators and functions.


def drop_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_columns(table(spark, sf_dir, "events"), ["props", "not_there"])


def rename_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {
        "event_id": "event_uuid",
        "event_type": "event_name",
        "ts": "event_timestamp",
        "not_there": "anything",
    }
    return rename_columns(table(spark, sf_dir, "events"), mapping)


def dedup_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(table(spark, sf_dir, "part").select("p_brand", "p_type", "p_size"))


def dedup_first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_row_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


def fn_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_view(spark, sf_dir).select("event_uuid", user_id().alias("user_id"))


def fn_null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = or_default("country_code", "UNKNOWN").alias("country_code")
    return bronze_view(spark, sf_dir).select("event_uuid", country)


def fn_md5_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_view(spark, sf_dir).select("event_uuid", user_key().alias("user_key"))


def fn_concat_ws_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [as_text(c) for c in ("p_brand", "p_type", "p_size")]
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws("|", *parts).alias("part_text")
    )


def fn_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", upper_text("p_name").alias("p_name"))


def fn_cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(as_text("event_id").alias("event_uuid"))


def fn_parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _utc(parse_timestamp(as_text("ts"))).alias("ts")
    return table(spark, sf_dir, "events").select("event_id", parsed)


# ---------------------------------------------------------------------------
# Tables and counts.


def bronze_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(bronze_view(spark, sf_dir))


def gold_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tables from one staged view: its joins run once, not once per table."""
    return table_counts(gold_tables(silver_tables(_staged(bronze_view(spark, sf_dir), "bronze"))))


def _silver_query(name: str) -> Query:
    return lambda spark, sf_dir: SILVER_TABLES[name](bronze_view(spark, sf_dir))


def _gold_query(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold = gold_table(name, SILVER_TABLES[name](bronze_view(spark, sf_dir)))
        return _as_zoneless(gold) if "EVENT_TIMESTAMP" in gold.columns else gold

    return query


def queries() -> dict[str, Query]:
    return {
        "csv_scan_typed": csv_scan_typed,
        "bronze_ingest": bronze_ingest,
        "bronze_ingest_whole": bronze_ingest_whole,
        "bronze_ingest_multiline": bronze_ingest_multiline,
        "bronze_count": bronze_count,
        "drop_columns": drop_columns_query,
        "rename_columns": rename_columns_query,
        "dedup_full_row": dedup_full_row,
        "dedup_first_by_key": dedup_first_by_key,
        "fn_coalesce": fn_coalesce,
        "fn_null_default": fn_null_default,
        "fn_md5_key": fn_md5_key,
        "fn_concat_ws_key": fn_concat_ws_key,
        "fn_upper": fn_upper,
        "fn_cast_string": fn_cast_string,
        "fn_parse_timestamp": fn_parse_timestamp,
        **{f"silver_{name}": _silver_query(name) for name in TABLE_NAMES},
        "silver_csv_export": silver_csv_export,
        "silver_csv_export_facts": silver_csv_export_facts,
        "silver_parquet_scan": silver_parquet_scan,
        **{f"gold_{name}": _gold_query(name) for name in TABLE_NAMES},
        "gold_parquet_roundtrip": gold_parquet_roundtrip,
        "gold_row_counts": gold_row_counts,
        "warehouse_create": warehouse_create,
        "warehouse_load": warehouse_load,
        "warehouse_truncate": warehouse_truncate,
        "refresh_counts": refresh_counts,
        "refresh_fact_events": refresh_fact_events,
        "refresh_reconciled": refresh_reconciled,
        "refresh_resumed": refresh_resumed,
        "key_audit": key_audit,
        "csv_rescue": csv_rescue,
        "snapshot_publish": snapshot_publish,
        "daily_row_counts": daily_row_counts,
        "daily_dim_user": daily_dim_user,
        "silver_dim_user_by_days": silver_dim_user_by_days,
        **(llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}),
    }


# ---------------------------------------------------------------------------
# Oracle SQL.

BRONZE_SQL = """
WITH np AS (SELECT max(page_id) + 1 AS n FROM pages),
bronze AS (
  SELECT
    CAST(e.event_id AS STRING) AS event_uuid,
    e.event_type AS event_name,
    e.ts AS event_timestamp,
    CASE WHEN e.user_id % 50 <> 49 THEN concat('d', CAST(e.user_id AS STRING)) END AS distinct_id,
    concat('p', CAST(e.user_id % 100 AS STRING)) AS person_id,
    CASE WHEN e.event_id % 3 = 0 THEN concat('ph', CAST(e.user_id AS STRING)) END AS posthog_user_id,
    CASE WHEN e.event_id % 5 = 0 THEN concat('app', CAST(e.user_id AS STRING)) END AS app_user_id,
    CASE WHEN e.event_id % 7 = 0 THEN cu.c_name END AS prop_user_id,
    CASE WHEN e.event_id % 4 <> 0
         THEN concat(CAST(e.user_id AS STRING), '-', CAST(CAST(e.ts AS DATE) AS STRING)) END AS session_id,
    CASE WHEN e.event_id % 8 = 0 THEN concat('s', CAST(e.user_id AS STRING)) END AS prop_session_id,
    regexp_extract(p.url, '^https?://[^/?#]+([^?#]*)', 1) AS pathname,
    p.url AS current_url,
    regexp_extract(p.url, '^https?://([^/?#]+)', 1) AS host,
    CASE WHEN e.event_id % 3 = 0 THEN 'canvas' END AS surface,
    CASE WHEN e.user_id % 3 = 0 THEN 'Mobile' WHEN e.user_id % 3 = 1 THEN 'Desktop' END AS device_type,
    CASE e.user_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' WHEN 2 THEN 'Firefox' END AS browser,
    CASE WHEN e.user_id % 5 <> 0
         THEN concat(CAST(100 + e.user_id % 7 AS STRING), '.10') END AS browser_version,
    CASE WHEN e.user_id % 2 = 0 THEN 'Mac OS X' ELSE 'Windows' END AS os,
    CASE WHEN e.user_id % 6 <> 0 THEN CAST(10 + e.user_id % 2 AS STRING) END AS os_version,
    CASE WHEN e.user_id % 9 <> 0 THEN 'en-US' END AS browser_language,
    CASE WHEN e.user_id % 11 <> 0 THEN n.n_name END AS country_name,
    CASE WHEN e.user_id % 13 <> 0 THEN concat('N', CAST(n.n_nationkey AS STRING)) END AS country_code
  FROM events e
  CROSS JOIN np
  LEFT JOIN pages p ON e.event_id % np.n = p.page_id
  LEFT JOIN customer cu ON e.user_id = cu.c_custkey
  LEFT JOIN nation n ON cu.c_nationkey = n.n_nationkey
)
"""

KEY_TEXT_SQL = {
    "user": "distinct_id",
    "device": """concat_ws('|', coalesce(device_type, ''), coalesce(browser, ''),
  coalesce(browser_version, ''), coalesce(os, ''), coalesce(os_version, ''),
  coalesce(browser_language, ''))""",
    "geo": "coalesce(country_code, 'UNKNOWN')",
    "session": "coalesce(session_id, prop_session_id, 'null')",
    "page": "concat_ws('|', coalesce(host, ''), coalesce(pathname, ''))",
}
USER_KEY_SQL, DEVICE_KEY_SQL, GEO_KEY_SQL, SESSION_KEY_SQL, PAGE_KEY_SQL = (
    f"substr(md5({text}), 1, 16)" for text in KEY_TEXT_SQL.values()
)

SILVER_SQL = {
    "dim_user": f"""
        SELECT distinct_id, person_id, user_id, {USER_KEY_SQL} AS user_key
        FROM (SELECT distinct_id, person_id,
                     coalesce(posthog_user_id, app_user_id, prop_user_id) AS user_id,
                     row_number() OVER (PARTITION BY distinct_id
                                        ORDER BY event_timestamp, event_uuid) AS rn
              FROM bronze) WHERE rn = 1""",
    "dim_device": f"""
        SELECT DISTINCT device_type, browser, browser_version, os, os_version, browser_language,
               {DEVICE_KEY_SQL} AS device_key FROM bronze""",
    "dim_geo": f"""
        SELECT DISTINCT country_name, country_code, {GEO_KEY_SQL} AS geo_key FROM bronze""",
    "dim_session": f"""
        SELECT DISTINCT coalesce(session_id, prop_session_id) AS session_id,
               {SESSION_KEY_SQL} AS session_key FROM bronze""",
    "dim_page": f"""
        SELECT DISTINCT pathname, current_url, host, surface, {PAGE_KEY_SQL} AS page_key
        FROM bronze""",
    "fact_events": f"""
        SELECT event_uuid, event_name, event_timestamp, {USER_KEY_SQL} AS user_key,
               {DEVICE_KEY_SQL} AS device_key, {GEO_KEY_SQL} AS geo_key,
               {SESSION_KEY_SQL} AS session_key, {PAGE_KEY_SQL} AS page_key
        FROM bronze""",
}

GOLD_SELECT_SQL = {
    "dim_user": "upper(user_key) AS USER_KEY, distinct_id AS DISTINCT_ID, person_id AS PERSON_ID,"
    " coalesce(user_id, distinct_id) AS USER_ID",
    "dim_device": "upper(device_key) AS DEVICE_KEY, browser AS BROWSER, os AS OS",
    "dim_geo": "upper(geo_key) AS GEO_KEY, country_code AS COUNTRY_CODE",
    "dim_session": "upper(session_key) AS SESSION_KEY, session_id AS SESSION_ID",
    "dim_page": "upper(page_key) AS PAGE_KEY, pathname AS PATHNAME",
    "fact_events": "event_uuid AS EVENT_UUID, event_name AS EVENT_NAME,"
    " event_timestamp AS EVENT_TIMESTAMP, upper(user_key) AS USER_KEY,"
    " upper(device_key) AS DEVICE_KEY, upper(geo_key) AS GEO_KEY,"
    " upper(session_key) AS SESSION_KEY, upper(page_key) AS PAGE_KEY",
}


def oracle_sql() -> dict[str, str]:
    silver = {name: BRONZE_SQL + sql for name, sql in SILVER_SQL.items()}
    gold = {
        name: f"{BRONZE_SQL} SELECT {columns} FROM ({SILVER_SQL[name]}) AS silver"
        for name, columns in GOLD_SELECT_SQL.items()
    }
    row_counts = BRONZE_SQL + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n FROM ({sql}) AS {name}"
        for name, sql in SILVER_SQL.items()
    )
    tables = BRONZE_SQL + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n,"
        f" '{','.join(GOLD_TABLES[name])}' AS column_names FROM ({sql}) AS {name}"
        for name, sql in SILVER_SQL.items()
    )
    events = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
    counted = {
        "bronze to silver: fact_events": "SELECT count(*) AS n FROM bronze",
        **{f"silver to gold: {name}": f"SELECT count(*) AS n FROM ({sql}) AS t" for name, sql in SILVER_SQL.items()},
        **{f"gold to warehouse: {name}": f"SELECT count(*) AS n FROM ({sql}) AS t" for name, sql in SILVER_SQL.items()},
        **{
            f"keys: dim_{key}": f"SELECT count(DISTINCT {key}_key) AS n FROM ({SILVER_SQL['fact_events']}) AS t"
            for key in KEY_TEXT_SQL
        },
    }
    reconciled = BRONZE_SQL + " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, n AS expected, n AS found FROM ({sql}) AS c" for name, sql in counted.items()
    )
    key_audit_sql = f"""
        SELECT key_name, substr(md5(text), 1, {SHORT_KEY}) AS key, min(text) AS smallest, max(text) AS largest
        FROM ({" UNION ALL ".join(f"SELECT '{k}_key' AS key_name, {sql} AS text FROM bronze" for k, sql in KEY_TEXT_SQL.items())}) AS texts
        WHERE text IS NOT NULL GROUP BY 1, 2 HAVING min(text) <> max(text)"""
    return {
        "csv_scan_typed": events,
        "bronze_ingest": events,
        "bronze_ingest_whole": events,
        "bronze_ingest_multiline": f"""
            SELECT event_id, ts, user_id, event_type, value, props, {NOTE_SQL} AS note FROM events""",
        "bronze_count": BRONZE_SQL + "SELECT count(*) AS n FROM bronze",
        "drop_columns": "SELECT event_id, ts, user_id, event_type, value FROM events",
        "rename_columns": """
            SELECT event_id AS event_uuid, ts AS event_timestamp, user_id,
                   event_type AS event_name, value, props FROM events""",
        "dedup_full_row": "SELECT DISTINCT p_brand, p_type, p_size FROM part",
        "dedup_first_by_key": """
            SELECT event_id, ts, user_id, event_type, value, props
            FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
                  FROM events) WHERE rn = 1""",
        "fn_coalesce": BRONZE_SQL
        + """SELECT event_uuid, coalesce(posthog_user_id, app_user_id, prop_user_id) AS user_id
             FROM bronze""",
        "fn_null_default": BRONZE_SQL
        + "SELECT event_uuid, coalesce(country_code, 'UNKNOWN') AS country_code FROM bronze",
        "fn_md5_key": BRONZE_SQL + f"SELECT event_uuid, {USER_KEY_SQL} AS user_key FROM bronze",
        "fn_concat_ws_key": """
            SELECT p_partkey, concat_ws('|', p_brand, p_type, CAST(p_size AS STRING)) AS part_text
            FROM part""",
        "fn_upper": "SELECT p_partkey, upper(p_name) AS p_name FROM part",
        "fn_cast_string": "SELECT CAST(event_id AS STRING) AS event_uuid FROM events",
        "fn_parse_timestamp": "SELECT event_id, ts FROM events",
        **{f"silver_{name}": sql for name, sql in silver.items()},
        "silver_csv_export": silver["dim_page"],
        "silver_csv_export_facts": silver["fact_events"],
        "silver_parquet_scan": silver["fact_events"],
        **{f"gold_{name}": sql for name, sql in gold.items()},
        "gold_parquet_roundtrip": gold["fact_events"],
        "gold_row_counts": row_counts,
        "warehouse_create": tables,
        "warehouse_load": gold["dim_page"],
        "warehouse_truncate": BRONZE_SQL
        + """SELECT count(*) AS loaded, CAST(0 AS BIGINT) AS emptied, count(*) AS reloaded
             FROM bronze""",
        "refresh_counts": row_counts,
        "refresh_fact_events": gold["fact_events"],
        "refresh_reconciled": reconciled,
        "refresh_resumed": row_counts,
        "key_audit": BRONZE_SQL + key_audit_sql,
        "csv_rescue": f"""
            SELECT event_id, 'ts' AS column_name, {GARBAGE_SQL["ts"]} AS text FROM events WHERE event_id % 97 = 0
            UNION ALL
            SELECT event_id, 'value' AS column_name, '12,5' AS text FROM events WHERE event_id % 89 = 0""",
        "snapshot_publish": row_counts,
        "daily_row_counts": row_counts,
        "daily_dim_user": gold["dim_user"],
        "silver_dim_user_by_days": silver["dim_user"],
        **(llm.oracle_sql() if llm else {}),
    }
