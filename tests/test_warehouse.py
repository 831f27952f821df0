from __future__ import annotations

import re
import shutil
from uuid import uuid4

import pytest

from starflow.columns import GOLD_TABLES
from starflow.operators import table_counts
from starflow.sources import (
    create_tables,
    load_from_lake,
    load_table,
    read_parquet,
    table_name,
    truncate_table,
    warehouse_tables,
    write_parquet,
)


@pytest.fixture
def database(spark, tmp_path):
    name = f"wh_{uuid4().hex}"
    create_tables(spark, name, str(tmp_path / "warehouse"))
    return name


def loaded(spark, database, table):
    return sorted(tuple(r) for r in spark.table(table_name(database, table)).collect())


def test_tables_have_the_declared_columns(spark, database):
    for table, columns in GOLD_TABLES.items():
        assert dict(spark.table(table_name(database, table)).dtypes) == columns


def test_creating_again_keeps_rows(spark, database):
    load_table(spark, database, "dim_geo", spark.sql("SELECT 'K' AS GEO_KEY, 'DE' AS COUNTRY_CODE"))
    create_tables(spark, database)
    assert loaded(spark, database, "dim_geo") == [("K", "DE")]


def test_columns_match_by_name_in_any_case_and_order(spark, database):
    load_table(spark, database, "dim_geo", spark.sql("SELECT 'DE' AS country_code, 'K' AS Geo_Key"))
    assert loaded(spark, database, "dim_geo") == [("K", "DE")]


def test_missing_columns_are_null_and_others_are_left_out(spark, database):
    load_table(spark, database, "dim_geo", spark.sql("SELECT 'K' AS GEO_KEY, 1 AS more"))
    assert loaded(spark, database, "dim_geo") == [("K", None)]
    with pytest.raises(ValueError, match="no column matches"):
        load_table(spark, database, "dim_geo", spark.sql("SELECT 1 AS more"))


def test_a_load_replaces_all_rows(spark, database):
    for code in ("DE", "FR"):
        rows = spark.sql(f"SELECT 'K' AS GEO_KEY, '{code}' AS COUNTRY_CODE")
        load_table(spark, database, "dim_geo", rows)
    assert loaded(spark, database, "dim_geo") == [("K", "FR")]


def test_a_load_that_fails_leaves_the_old_rows(spark, database):
    load_table(spark, database, "dim_geo", spark.sql("SELECT 'K' AS GEO_KEY, 'DE' AS COUNTRY_CODE"))
    broken = spark.range(0, 1000, 1, 4).selectExpr(
        "CASE WHEN id = 900 THEN raise_error('half-way') ELSE 'K2' END AS GEO_KEY", "'FR' AS COUNTRY_CODE"
    )
    with pytest.raises(Exception, match="half-way"):
        load_table(spark, database, "dim_geo", broken)
    assert loaded(spark, database, "dim_geo") == [("K", "DE")]


def test_old_loads_are_removed_and_a_table_can_load_itself(spark, database, tmp_path):
    for code in ("DE", "FR", "IT", "ES"):
        rows = spark.sql(f"SELECT 'K' AS GEO_KEY, '{code}' AS COUNTRY_CODE")
        load_table(spark, database, "dim_geo", rows)
    load_table(spark, database, "dim_geo", spark.table(table_name(database, "dim_geo")))
    assert loaded(spark, database, "dim_geo") == [("K", "ES")]
    assert len(list((tmp_path / "warehouse" / "dim_geo" / "loads").iterdir())) == 2


def test_gold_without_a_key_is_refused(spark, database, tmp_path):
    gold = tmp_path / "gold"
    for table, columns in GOLD_TABLES.items():
        names = {c: "USERKEY" if c == "USER_KEY" and table == "dim_user" else c for c in columns}
        fields = ", ".join(f"CAST(NULL AS {t}) AS {names[c]}" for c, t in columns.items())
        write_parquet(spark.sql(f"SELECT {fields}"), str(gold / table))
    with pytest.raises(ValueError, match="dim_user"):
        load_from_lake(spark, database, str(gold))
    assert loaded(spark, database, "fact_events") == []


def test_mismatched_columns_are_logged(spark, database, caplog):
    load_table(spark, database, "dim_geo", spark.sql("SELECT 'K' AS GEO_KEY, 1 AS more"))
    assert "COUNTRY_CODE" in caplog.text and "more" in caplog.text


def test_a_location_may_hold_quotes(spark, tmp_path):
    name = f"wh_{uuid4().hex}"
    create_tables(spark, name, str(tmp_path / "o'clock"))
    load_table(spark, name, "dim_geo", spark.sql("SELECT 'K' AS GEO_KEY, 'DE' AS COUNTRY_CODE"))
    assert loaded(spark, name, "dim_geo") == [("K", "DE")]


def test_truncate_leaves_an_empty_table(spark, database):
    load_table(spark, database, "dim_geo", spark.sql("SELECT 'K' AS GEO_KEY, 'DE' AS COUNTRY_CODE"))
    truncate_table(spark, database, "dim_geo")
    assert loaded(spark, database, "dim_geo") == []


def test_only_parquet_files_are_loaded(spark, database, tmp_path):
    gold = tmp_path / "gold"
    for table, columns in GOLD_TABLES.items():
        fields = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in columns.items())
        write_parquet(spark.sql(f"SELECT {fields}"), str(gold / table))
        (gold / table / "notes.txt").write_text("not a table")
    part = next((gold / "dim_geo").glob("*.parquet"))
    shutil.copy(part, gold / "dim_geo" / "part-copy.parquet.bak")
    load_from_lake(spark, database, str(gold))
    counts = {r.table_name: r.n for r in table_counts(warehouse_tables(spark, database)).collect()}
    assert counts == dict.fromkeys(GOLD_TABLES, 1)


def test_a_table_without_files_is_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception, match="(?i)schema"):
        read_parquet(spark, str(tmp_path / "empty"))


def test_counts_read_no_column(spark, database):
    plan = table_counts(warehouse_tables(spark, database))._jdf.queryExecution().executedPlan()
    schemas = re.findall(r"ReadSchema: (\S+)", plan.toString())
    assert schemas == ["struct<>"] * len(GOLD_TABLES)
