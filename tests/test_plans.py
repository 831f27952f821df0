"""Plans that must hold at any size: pruned scans, few shuffles, no Python, no hot task."""

from __future__ import annotations

import re

import pytest
from oracle import SMALL, oracle, rows_of
from pyspark.sql import functions as F

import __spark_entry__ as driver
from starflow.columns import COLUMN_NAMES, SILVER_INPUTS, TABLE_NAMES
from starflow.operators import clean
from starflow.plans import SILVER_TABLES, gold_table, ingest_bronze
from starflow.sample_clicks import bronze_view, raw_export, table
from starflow.sources import write_csv


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    write_csv(raw_export(spark, SMALL), str(root / "raw"))
    return clean(ingest_bronze(spark, str(root / "raw"), str(root / "bronze")))


@pytest.mark.parametrize("name", TABLE_NAMES)
def test_silver_reads_only_its_own_columns(events, name):
    df = SILVER_TABLES[name](events)
    scan = df._jdf.queryExecution().optimizedPlan().toString()
    raw = {model: raw for raw, model in COLUMN_NAMES.items()}
    read = {f.split("#")[0] for f in re.findall(r"[\w$]+#\d+", plan_of(df).split("FileScan")[1])}
    assert read == {raw.get(c, c) for c in SILVER_INPUTS[name]}, scan


@pytest.mark.parametrize("name", TABLE_NAMES)
def test_silver_shuffles_once_per_dimension_and_never_for_facts(events, name):
    plan = plan_of(SILVER_TABLES[name](events))
    assert plan.count("Exchange") == (0 if name == "fact_events" else 1)
    assert "Coalesce" not in plan and "Python" not in plan
    if name != "fact_events":
        below = plan.split("Exchange")[1]
        assert "Aggregate" in below, "rows are combined before the shuffle"
        assert "md5" not in below, "keys are hashed after the shuffle"


@pytest.mark.parametrize("name", TABLE_NAMES)
def test_gold_is_a_projection(spark, events, tmp_path, name):
    silver = SILVER_TABLES[name](events)
    silver.write.parquet(str(tmp_path / name))
    plan = plan_of(gold_table(name, spark.read.parquet(str(tmp_path / name))))
    assert "Exchange" not in plan and "Aggregate" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", [n for n in driver.queries() if n.startswith(("fn_", "dedup_", "silver_dim", "gold_dim"))])
def test_no_query_pairs_rows_without_a_key(spark, name):
    plan = plan_of(driver.queries()[name](spark, SMALL))
    assert not re.search("Cartesian|NestedLoop|Python", plan)


def test_pages_are_read_without_their_html(spark):
    assert "html" not in plan_of(bronze_view(spark, SMALL))


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    """The sample tables, where a third of the events are one user's on one page.

    Another tenth are exact copies of one event.
    """
    root = tmp_path_factory.mktemp("hot")
    for name in ("pages", "customer", "nation"):
        table(spark, SMALL, name).write.parquet(f"{root}/{name}.parquet")
    events = table(spark, SMALL, "events").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(19))))
    repeated = events.withColumn("event_id", F.col("event_id") + F.col("copy") * 1000).drop("copy")
    one = table(spark, SMALL, "events").filter("event_id = 7")
    pages = table(spark, SMALL, "pages").count()
    again = F.explode(F.sequence(F.lit(1), F.lit(12_000))).alias("copy")
    hot = one.select("*", again).selectExpr(
        f"event_id + {pages} * (copy + 100000L) AS event_id",
        "ts + make_dt_interval(0, 0, 0, copy) AS ts",
        "user_id",
        "event_type",
        "value",
        "props",
    )
    copies = one.select("*", again).filter("copy <= 3600").drop("copy")
    events = repeated.unionByName(hot).unionByName(copies)
    events.repartition(16).write.parquet(f"{root}/events.parquet")
    return str(root)


@pytest.fixture
def shuffled_joins(spark):
    """Joins as large tables get them, with thresholds that suit small ones."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", TABLE_NAMES)
def test_a_third_of_the_rows_under_one_key(spark, hot_dir, shuffled_joins, name):
    silver = driver.queries()[f"silver_{name}"](spark, hot_dir)
    rows = rows_of(silver)
    if name == "fact_events":
        assert plan_of(silver).count("skew=true") >= 2, "hot page and hot user are split"
    sql = driver.oracle_sql()[f"silver_{name}"]
    for source in ("events", "pages", "customer", "nation"):
        files = f"read_parquet('{hot_dir}/{source}.parquet/*.parquet')"
        sql = re.sub(rf"\b(FROM|JOIN) {source}\b", rf"\1 {files}", sql)
    assert rows == oracle(SMALL, sql)
