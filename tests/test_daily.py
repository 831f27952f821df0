"""Loads by execution date, and publishing all tables together."""

from __future__ import annotations

from collections import Counter
from pathlib import Path
from uuid import uuid4

import pytest
from oracle import SMALL, oracle, rows_of

import __spark_entry__ as driver
from starflow.columns import GOLD_TABLES
from starflow.plans import RefreshConfig, gold_tables, run_day, silver_tables
from starflow.sample_clicks import bronze_view, raw_export
from starflow.sources import (
    Part,
    create_snapshots,
    current_parts,
    go_back,
    load_parts,
    manifest_location,
    publish,
    published_tables,
    remove_unpublished,
    write_csv,
)

ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def raw_by_date(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    export = raw_export(spark, SMALL)
    for date, days in driver._THIRDS.items():
        write_csv(export.filter(f"day(timestamp) {days}"), str(root / date))
    write_csv(export.filter("day(timestamp) BETWEEN 11 AND 20").limit(40), str(root / "other"))
    return root


@pytest.fixture
def config(tmp_path):
    return RefreshConfig("", str(tmp_path / "lake"), f"daily_{uuid4().hex}", str(tmp_path / "warehouse"))


def equal_to_a_full_refresh(spark, database):
    for name, df in published_tables(spark, database).items():
        if name == "fact_events":
            df = driver._as_zoneless(df)
        assert rows_of(df) == oracle(SMALL, ORACLES[f"gold_{name}"]), name


def test_dates_in_any_order_and_again_equal_a_full_refresh(spark, config, raw_by_date):
    first, second, third = driver._THIRDS
    run_day(spark, config, second, str(raw_by_date / "other"))  # to be replaced
    run_day(spark, config, third.replace("-", ""), str(raw_by_date / third))
    run_day(spark, config, first, str(raw_by_date / first))
    with pytest.raises(AssertionError):
        equal_to_a_full_refresh(spark, config.database)
    before = current_parts(spark, config.database)
    run_day(spark, config, second, str(raw_by_date / second))
    equal_to_a_full_refresh(spark, config.database)
    after = current_parts(spark, config.database)
    # Facts of other dates are carried over as they are.
    assert {p for p in before if p.part in (first, third)} <= set(after)
    assert [p.part for p in after if p.table == "fact_events"] == [first, second, third]


def test_the_export_is_dealt_to_dates_in_one_pass_and_a_date_may_have_none(spark, tmp_path, monkeypatch):
    """Events of the first third of a month, and some without a time, which no date has."""
    for path in Path(SMALL).glob("*.parquet"):
        if path.name != "events.parquet":
            (tmp_path / path.name).symlink_to(path)
    day = "CASE WHEN id < 40 THEN make_timestamp_ntz(2024, 1, CAST(1 + id % 10 AS INT), 1, 2, 3.000004) END"
    events = spark.range(50).selectExpr(
        "id AS event_id", f"{day} AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.5D AS value", "'{}' AS props"
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(driver, "_staged", None)  # that would be a second pass
    tables = driver._daily(spark, str(tmp_path))
    assert tables["fact_events"].count() == 40
    assert rows_of(tables["dim_user"]) == rows_of(driver.queries()["gold_dim_user"](spark, str(tmp_path)))


def test_dates_are_dates(spark, config, raw_by_date):
    with pytest.raises(ValueError, match="execution date"):
        run_day(spark, config, "2025-9-1/..", str(raw_by_date / "other"))


@pytest.fixture
def database(spark, tmp_path):
    name = f"snap_{uuid4().hex}"
    create_snapshots(spark, name, str(tmp_path / "warehouse"))
    create_snapshots(spark, name, str(tmp_path / "warehouse"))
    return name


@pytest.fixture(scope="module")
def gold(spark):
    return gold_tables(silver_tables(bronze_view(spark, SMALL)))


def contents(spark, database):
    return {name: Counter(map(tuple, df.collect())) for name, df in published_tables(spark, database).items()}


@pytest.mark.parametrize("concurrent", [True, False])
def test_a_load_that_fails_at_one_table_moves_none(spark, database, gold, concurrent):
    assert all(not rows for rows in contents(spark, database).values())
    load_parts(spark, database, gold, concurrent=concurrent)
    old = contents(spark, database)
    assert all(old.values())
    fewer = {name: df.limit(1) for name, df in gold.items()}
    fourth = list(fewer)[3]
    fewer[fourth] = fewer[fourth].selectExpr("SESSION_KEY", "raise_error('no') AS SESSION_ID")
    with pytest.raises(Exception, match="no"):
        load_parts(spark, database, fewer, concurrent=concurrent)
    assert contents(spark, database) == old


def test_readers_keep_the_tables_they_began_with(spark, database, gold):
    load_parts(spark, database, gold)
    held, old = published_tables(spark, database), contents(spark, database)
    first = manifest_location(spark, database)
    load_parts(spark, database, {name: df.limit(1) for name, df in gold.items()})
    assert {name: Counter(map(tuple, df.collect())) for name, df in held.items()} == old
    assert all(sum(rows.values()) == 1 for rows in contents(spark, database).values())
    go_back(spark, database, first)
    assert contents(spark, database) == old


def test_what_no_manifest_lists_can_be_removed(spark, database, gold):
    manifests = []
    for n in (1, 2, 3):
        load_parts(spark, database, {name: df.limit(n) for name, df in gold.items()})
        manifests.append(manifest_location(spark, database))
    removed = remove_unpublished(spark, database, keep=[manifests[1]])
    assert len(removed) == 6 + 1  # the first load's folders and its manifest
    go_back(spark, database, manifests[1])
    assert all(sum(rows.values()) == 2 for rows in contents(spark, database).values())
    assert len(remove_unpublished(spark, database, keep=[])) == 6 + 1  # the third load's


def test_columns_are_matched_by_name_and_tables_known(spark, database, gold):
    page = gold["dim_page"].selectExpr("PATHNAME AS pathname", "1 AS more", "PAGE_KEY AS page_key")
    load_parts(spark, database, {"dim_page": page})
    found = published_tables(spark, database)
    assert found["dim_page"].columns == list(GOLD_TABLES["dim_page"])
    assert found["dim_page"].filter("PAGE_KEY IS NULL").isEmpty() and found["dim_user"].isEmpty()
    with pytest.raises(ValueError, match="not published"):
        load_parts(spark, database, {"dim_other": page})
    with pytest.raises(ValueError, match="twice"):
        publish(spark, database, [Part("dim_page", "", "a"), Part("dim_page", "", "b")])
