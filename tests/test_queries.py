"""Every registered query equals its oracle SQL, on whole tables."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from oracle import MEDIUM, SMALL, oracle, rows_of

import __spark_entry__ as driver

# The operators for training text have tests of their own.
APART = {*driver.llm.queries(), "pipeline"} if driver.llm else set()
QUERIES = {name: query for name, query in driver.queries().items() if name not in APART}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name not in APART}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM], ids=["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, name, sf_dir):
    columns, rows = rows_of(QUERIES[name](spark, sf_dir))
    expected_columns, expected_rows = oracle(sf_dir, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected_rows


def test_the_rest_works_without_the_training_text_operators(tmp_path):
    root = Path(driver.__file__).parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "starflow", tmp_path / "starflow", ignore=shutil.ignore_patterns("llm"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert ran.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))], ran.stderr


def test_entry_counts_every_table(spark):
    counts = driver.entry(spark)
    assert counts.columns == ["table_name", "n"]
    assert rows_of(counts) == oracle(SMALL, ORACLES["gold_row_counts"])


@pytest.mark.parametrize(
    "setting, value",
    [
        ("spark.sql.ansi.enabled", "false"),
        ("spark.sql.adaptive.enabled", "false"),
        ("spark.sql.session.timeZone", "America/New_York"),
        ("spark.sql.caseSensitive", "true"),
    ],
)
def test_results_do_not_hang_on_session_settings(spark, setting, value):
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        for name in ("csv_scan_typed", "silver_dim_user", "gold_fact_events", "warehouse_load"):
            found = rows_of(QUERIES[name](spark, SMALL))
            assert found == oracle(SMALL, ORACLES[name]), name
    finally:
        spark.conf.set(setting, before)
