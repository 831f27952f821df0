"""Checks that compare: keys, values that do not parse, rows that went missing, runs taken up again."""

from __future__ import annotations

from pathlib import Path
from uuid import uuid4

import pytest
from oracle import SMALL, oracle, rows_of

import __spark_entry__ as driver
from pyspark.sql import functions as F
from starflow.operators import (
    Mismatch,
    cast_declared,
    cast_rescuing,
    collisions,
    fail_on_mismatch,
    key_collisions,
    rescued_counts,
    rescued_values,
)
from starflow.plans import ChangedInput, RefreshConfig, load_report, run_once, run_refresh, verify
from starflow.plans.refresh import STAGES
from starflow.sample_clicks import bronze_view, raw_export
from starflow.sources import write_csv

ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def raw_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    write_csv(raw_export(spark, SMALL), path)
    return path


@pytest.fixture
def config(raw_path, tmp_path):
    return RefreshConfig(raw_path, str(tmp_path / "lake"), f"checks_{uuid4().hex}", str(tmp_path / "warehouse"))


# ---------------------------------------------------------------------------
# Keys.


def test_a_planted_collision_is_reported(spark):
    rows = spark.createDataFrame(
        [("k1", "a"), ("k1", "b"), ("k1", "c"), ("k2", "a"), ("k2", "a"), ("k3", None), (None, "x"), (None, "y"), ("k4", ""), ("k4", " ")],
        "key string, name string",
    )
    found = collisions(rows.withColumn("set", F.lit(1)), ["set"], F.col("key"), F.col("name"))
    assert sorted(map(tuple, found.collect())) == [(1, "k1", "a", "c"), (1, "k4", "", " ")]


def test_published_keys_do_not_collide_and_nulls_are_no_collision(spark):
    assert key_collisions(bronze_view(spark, SMALL)).isEmpty()


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    plan = key_collisions(bronze_view(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_max" in plan


# ---------------------------------------------------------------------------
# Values that do not parse.

TYPES = {"at": "timestamp", "n": "int", "x.y": "double"}
ROWS = [
    ("1", "2024-01-01 00:00:00", "7", "1.5"),
    ("2", "yesterday", "7.5", "1,5"),
    ("3", None, "", "  "),
    ("4", "2024-13-01", "99999999999", "7.25"),
    ("5", "2024-01-01T00:00:00Z", " 8 ", "1e3"),
]


def test_what_does_not_parse_is_kept_as_text(spark):
    raw = spark.createDataFrame(ROWS, "id string, at string, n string, `x.y` string")
    cast = cast_rescuing(raw, TYPES)
    plain = cast_declared(raw, TYPES)
    assert cast.columns == [*raw.columns, "rescued"]
    assert rows_of(cast.drop("rescued")) == rows_of(plain)
    assert sorted(map(tuple, rescued_values(cast, ["id"]).collect())) == [
        ("2", "at", "yesterday"), ("2", "n", "7.5"), ("2", "x.y", "1,5"), ("4", "at", "2024-13-01"), ("4", "n", "99999999999"),
    ]
    assert sorted(map(tuple, rescued_counts(cast).collect())) == [
        ("at", 2, "2024-13-01", "yesterday"), ("n", 2, "7.5", "99999999999"), ("x.y", 1, "1,5", "1,5"),
    ]
    assert {r.id for r in cast.filter("rescued IS NULL").collect()} == {"1", "3", "5"}


def test_nothing_to_cast_and_a_taken_name(spark):
    raw = spark.createDataFrame([("a",)], "id string")
    assert cast_rescuing(raw, TYPES).collect()[0].rescued is None
    assert cast_rescuing(raw.filter("false"), {"id": "int"}).collect() == []
    with pytest.raises(ValueError, match="rescued"):
        cast_rescuing(raw.withColumn("RESCUED", F.lit(1)), TYPES)


# ---------------------------------------------------------------------------
# Rows that went missing.


def one_file_fewer(folder):
    """Takes away the largest file of a folder as a failed copy would, by writing nothing in its place."""
    files = sorted(Path(folder).glob("*.parquet"), key=lambda p: p.stat().st_size)
    files[-1].unlink()
    (files[-1].parent / f".{files[-1].name}.crc").unlink(missing_ok=True)


def test_a_full_refresh_agrees(spark, config):
    run_refresh(spark, config)
    verify(spark, config)
    names = [r.check_name for r in load_report(spark, config).collect()]
    assert len(names) == len(set(names)) == 1 + 6 + 6 + 5


def test_a_dropped_file_fails_the_run(spark, config):
    STAGES["ingest"](spark, config)
    STAGES["silver"](spark, config)
    STAGES["gold"](spark, config)
    one_file_fewer(f"{config.gold_root}/dim_page")
    if not list(Path(f"{config.gold_root}/dim_page").glob("*.parquet")):
        driver.SILVER_TABLES["dim_page"](bronze_view(spark, SMALL)).limit(0).selectExpr(
            "page_key AS PAGE_KEY", "pathname AS PATHNAME"
        ).write.mode("overwrite").parquet(f"{config.gold_root}/dim_page")
    STAGES["warehouse"](spark, config)
    with pytest.raises(Mismatch, match="keys: dim_page.*silver to gold: dim_page") as failed:
        verify(spark, config)
    assert "dim_user" not in str(failed.value)


def test_every_disagreement_is_named(spark):
    report = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", 0, None)], "check_name string, expected long, found long")
    with pytest.raises(Mismatch, match="^b: expected 1, found 2; c: expected 0, found None$"):
        fail_on_mismatch(report)
    fail_on_mismatch(report.filter("check_name = 'a'"))


# ---------------------------------------------------------------------------
# Runs that are taken up again.


def counted(seen, stop=None):
    def stage(name):
        def run(spark, config):
            seen.append(name)
            if name == stop:
                raise InterruptedError(name)
            STAGES[name](spark, config)

        return run

    return {name: stage(name) for name in STAGES}


def test_a_run_goes_on_where_it_stopped_and_refuses_other_input(spark, config, tmp_path, raw_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for file in Path(raw_path).glob("*.csv"):
        (raw / file.name).write_bytes(file.read_bytes())
    config = RefreshConfig(str(raw), config.lake_root, config.database, config.database_location)
    seen = []
    with pytest.raises(InterruptedError):
        run_once(spark, config, "monday", counted(seen, stop="gold"))
    assert seen == ["ingest", "silver", "gold"]
    seen.clear()
    counts = run_once(spark, config, "monday", counted(seen))
    assert seen == ["gold", "warehouse"]
    assert rows_of(counts) == oracle(SMALL, ORACLES["gold_row_counts"])
    seen.clear()
    run_once(spark, config, "monday", counted(seen))
    assert seen == []
    with pytest.raises(ChangedInput, match="settings"):
        run_once(spark, RefreshConfig(**{**config.__dict__, "time_zone": "Asia/Tokyo"}), "monday", counted(seen))
    (raw / "more.csv").write_text(next(raw.glob("*.csv")).read_text().split("\n")[0] + "\n")
    with pytest.raises(ChangedInput, match="files"):
        run_once(spark, config, "monday", counted(seen))
    assert seen == []
    run_once(spark, config, "tuesday", counted(seen))
    assert seen == list(STAGES)
    with pytest.raises(ValueError, match="name"):
        run_once(spark, config, "../x")
