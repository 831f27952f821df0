"""Raw CSV to warehouse, end to end."""

from __future__ import annotations

from dataclasses import replace
from uuid import uuid4

import pytest
from oracle import SMALL, oracle, rows_of

import __spark_entry__ as driver
import run_job
from starflow.columns import TABLE_NAMES
from starflow.operators import cast_declared
from starflow.plans import RefreshConfig, export_silver, run_refresh
from starflow.sample_clicks import raw_export
from starflow.sources import (
    for_each_table,
    read_csv,
    read_parquet,
    scratch_path,
    warehouse_tables,
    write_csv,
)

ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def raw_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    write_csv(raw_export(spark, SMALL), path)
    return path


@pytest.fixture
def config(raw_path, tmp_path):
    return RefreshConfig(
        raw_path,
        str(tmp_path / "lake"),
        f"refresh_{uuid4().hex}",
        str(tmp_path / "warehouse"),
    )


def assert_all_tables_equal_their_oracles(spark, database):
    for name, df in warehouse_tables(spark, database).items():
        if name == "fact_events":
            df = driver._as_zoneless(df)
        assert rows_of(df) == oracle(SMALL, ORACLES[f"gold_{name}"]), name


@pytest.mark.parametrize("concurrent", [True, False])
def test_every_table_equals_its_oracle(spark, config, concurrent):
    config = replace(config, concurrent=concurrent)
    counts = run_refresh(spark, config)
    assert rows_of(counts) == oracle(SMALL, ORACLES["gold_row_counts"])
    assert_all_tables_equal_their_oracles(spark, config.database)


def test_running_twice_gives_the_same_tables(spark, config):
    run_refresh(spark, config).collect()
    run_refresh(spark, config).collect()
    assert_all_tables_equal_their_oracles(spark, config.database)


def test_stages_can_be_submitted_one_by_one(spark, config, capsys):
    paths = ["--raw", config.raw_path, "--lake", config.lake_root, "--database", config.database]
    more = ["--database-location", config.database_location, "--date", "20250901"]
    for stage in ("ingest", "silver", "gold", "warehouse"):
        run_job.main([stage, *paths, *more])
    printed = capsys.readouterr().out
    assert "fact_events: 1,000 rows" in printed
    assert_all_tables_equal_their_oracles(spark, config.database)


def test_the_job_goes_on_verifies_and_loads_a_date(spark, config, capsys):
    paths = ["--raw", config.raw_path, "--lake", config.lake_root, "--database", config.database]
    paths += ["--database-location", config.database_location]
    run_job.main(["all", *paths, "--run", "first"])
    bronze = read_parquet(spark, config.bronze_path).inputFiles()
    run_job.main(["all", *paths, "--run", "first"])
    assert read_parquet(spark, config.bronze_path).inputFiles() == bronze
    run_job.main(["verify", *paths])
    assert capsys.readouterr().out.count("fact_events: 1,000 rows") == 2
    days = [*paths[:5], config.database + "_daily", "--database-location", config.database_location + "_daily"]
    run_job.main(["day", *days, "--date", "20250901"])
    run_job.main(["day", *days, "--date", "2025-09-01"])
    assert capsys.readouterr().out.count("fact_events: 1,000 rows") == 2
    for bad in (["day", *paths], ["silver", *paths, "--run", "x"]):
        with pytest.raises(SystemExit):
            run_job.main(bad)


def test_silver_exports_to_csv_and_back(spark, config, tmp_path):
    run_refresh(spark, config)
    export_silver(spark, config.silver_root, str(tmp_path / "csv"))
    for name in TABLE_NAMES:
        silver = read_parquet(spark, f"{config.silver_root}/{name}")
        exported = read_csv(spark, str(tmp_path / "csv" / name), keep_empty=True)
        assert rows_of(cast_declared(exported)) == rows_of(silver), name


def test_a_failing_table_fails_the_stage(spark):
    def action(name):
        if name == "dim_geo":
            raise RuntimeError("no space")

    for concurrent in (True, False):
        with pytest.raises(RuntimeError, match="no space"):
            for_each_table(spark, TABLE_NAMES, action, concurrent)


def test_silver_can_be_exported_by_the_job(spark, config):
    run_refresh(spark, config)
    paths = ["--raw", config.raw_path, "--lake", config.lake_root, "--database", config.database]
    run_job.main(["export", *paths])
    for name in TABLE_NAMES:
        silver = read_parquet(spark, f"{config.silver_root}/{name}")
        exported = read_csv(spark, f"{config.export_root}/{name}", keep_empty=True)
        assert rows_of(cast_declared(exported)) == rows_of(silver), name


def test_job_settings_reach_the_ingest(spark, config):
    paths = ["--raw", config.raw_path, "--lake", config.lake_root, "--database", config.database]
    run_job.main(["ingest", *paths, "--reading", "whole", "--spread", "--max-records-per-file", "300"])
    sizes = read_parquet(spark, config.bronze_path).groupBy("_metadata.file_path").count().collect()
    assert sum(r["count"] for r in sizes) == 1000 and max(r["count"] for r in sizes) <= 300


def test_reordered_headers_fail_a_default_refresh(spark, config, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        run_refresh(spark, replace(config, raw_path=str(tmp_path / "*.csv")))


@pytest.fixture
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_times_do_not_depend_on_the_session_zone(spark, config, new_york):
    run_refresh(spark, config).collect()
    facts = driver._as_zoneless(warehouse_tables(spark, config.database)["fact_events"])
    assert rows_of(facts) == oracle(SMALL, ORACLES["gold_fact_events"])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert_all_tables_equal_their_oracles(spark, config.database)


class Session:
    """As much of a session as a scratch path needs."""

    def __init__(self, **settings):
        self.conf = {f"spark.{key}": value for key, value in settings.items()}


def test_scratch_is_shared_on_every_master():
    warehouse = {"sql.warehouse.dir": "s3a://lake/warehouse"}
    for master in ("yarn", "local[2]"):
        path = scratch_path(Session(master=master, **warehouse), "x")
        assert path.startswith("s3a://lake/warehouse/starflow/x-")
    shared = Session(**warehouse, **{"checkpoint.dir": "s3a://lake/scratch/"})
    assert scratch_path(shared, "x").startswith("s3a://lake/scratch/starflow/x-")


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(base) and first != second
