"""What holds between the fact table and its dimensions."""

from __future__ import annotations

import pytest
from oracle import MEDIUM
from pyspark.sql import functions as F

from starflow.plans import gold_tables, silver_tables
from starflow.sample_clicks import bronze_view, table

KEYS = {"dim_user": "user_key", "dim_device": "device_key", "dim_geo": "geo_key",
        "dim_session": "session_key", "dim_page": "page_key"}


@pytest.fixture(scope="module")
def silver(spark):
    return silver_tables(bronze_view(spark, MEDIUM))


def test_every_event_is_a_fact(spark, silver):
    assert silver["fact_events"].count() == table(spark, MEDIUM, "events").count()


@pytest.mark.parametrize("name", KEYS)
def test_every_fact_key_is_in_its_dimension(silver, name):
    key = KEYS[name]
    lost = silver["fact_events"].filter(F.col(key).isNotNull()).join(silver[name], key, "left_anti")
    assert lost.isEmpty()


@pytest.mark.parametrize("name", ["dim_user", "dim_device", "dim_session"])
def test_unique_keys(silver, name):
    assert silver[name].groupBy(KEYS[name]).count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("name, rows, keys, joined", [("dim_geo", 45, 26, 20708), ("dim_page", 500, 250, 20000)])
def test_keys_that_repeat_multiply_facts(silver, name, rows, keys, joined):
    dimension, key = silver[name], KEYS[name]
    assert dimension.count() == rows
    assert dimension.select(key).distinct().count() == keys
    assert silver["fact_events"].join(dimension, key).count() == joined


def test_null_user_is_one_row_that_no_fact_reaches(silver):
    assert silver["dim_user"].filter("distinct_id IS NULL AND user_key IS NULL").count() == 1
    assert silver["fact_events"].join(silver["dim_user"], "user_key").count() == 9784


def test_gold_keeps_rows_and_falls_back_for_user_id(silver):
    gold = gold_tables(silver)
    for name, df in gold.items():
        assert df.count() == silver[name].count()
    assert gold["fact_events"].schema["EVENT_TIMESTAMP"].dataType.simpleString() == "timestamp"
    assert gold["dim_user"].filter("USER_ID IS NULL AND DISTINCT_ID IS NOT NULL").isEmpty()


def test_events_are_not_deduplicated(silver, spark):
    events = bronze_view(spark, MEDIUM)
    twice = silver_tables(events.unionAll(events))
    assert twice["fact_events"].count() == 2 * silver["fact_events"].count()
    assert twice["dim_user"].exceptAll(silver["dim_user"]).isEmpty()
