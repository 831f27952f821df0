from __future__ import annotations

import datetime as dt

import pytest

from starflow.columns import COLUMN_NAMES, UNUSED_COLUMNS
from starflow.operators import (
    cast_declared,
    clean,
    drop_columns,
    rename_columns,
    require_columns,
    unexpected_columns,
)

RAW_COLUMNS = [*UNUSED_COLUMNS, "distinct_id", "person_id", *COLUMN_NAMES, "prop_other.thing"]


def raw(spark, columns=RAW_COLUMNS, **values):
    schema = ", ".join(f"`{name}` string" for name in columns)
    return spark.createDataFrame([tuple(values.get(name) for name in columns)], schema)


def test_clean_drops_renames_and_types(spark):
    events = clean(
        raw(
            spark,
            timestamp="2025-09-01T10:00:00.123456Z",
            distinct_id="007",
            **{"prop_$browser_version": "17.10", "prop_$viewport_width": "1024"},
            prop_credits_used="0.5",
            prop_credit_amount="many",
        )
    )
    assert events.columns == ["distinct_id", "person_id", *COLUMN_NAMES.values(), "prop_other.thing"]
    row = events.first()
    assert row.event_timestamp == dt.datetime(2025, 9, 1, 10, 0, 0, 123456)
    assert (row.distinct_id, row.browser_version) == ("007", "17.10")
    assert (row.viewport_width, row.credits_used, row.credit_amount) == (1024, 0.5, None)


def test_absent_columns_are_ignored(spark):
    df = spark.createDataFrame([("x", "1")], "`prop_$lib` string, uuid string")
    assert drop_columns(df, UNUSED_COLUMNS).columns == ["uuid"]
    assert rename_columns(df, COLUMN_NAMES).columns == ["prop_$lib", "event_uuid"]


def test_missing_needed_columns_are_all_named(spark):
    columns = [c for c in RAW_COLUMNS if c not in ("uuid", "prop_$host")]
    with pytest.raises(ValueError, match="event_uuid.*host"):
        clean(raw(spark, columns))


def test_names_ignore_case(spark):
    df = spark.createDataFrame([("1", "2")], "UUID string, Prop_$Lib string".replace("Prop_$Lib", "`Prop_$Lib`"))
    assert rename_columns(drop_columns(df, UNUSED_COLUMNS), COLUMN_NAMES).columns == ["event_uuid"]
    assert require_columns(df, ["uuid"]) is df


def test_rename_onto_an_existing_name_is_refused(spark):
    df = spark.createDataFrame([("1", "2")], "uuid string, EVENT_UUID string")
    with pytest.raises(ValueError, match="event_uuid"):
        rename_columns(df, COLUMN_NAMES)
    with pytest.raises(ValueError, match="c"):
        rename_columns(spark.sql("SELECT 1 AS a, 2 AS b"), {"a": "c", "b": "c"})


def test_rename_can_swap_names(spark):
    df = rename_columns(spark.sql("SELECT 1 AS a, 2 AS b"), {"a": "b", "b": "a"})
    assert df.first().asDict() == {"b": 1, "a": 2}


def test_typed_sources_keep_their_types(spark):
    df = spark.sql("SELECT timestamp_ntz'2025-09-01 10:00:00' AS event_timestamp, 5L AS screen_width")
    assert cast_declared(df).dtypes == df.dtypes


def test_unexpected_columns_are_reported(spark):
    assert unexpected_columns(raw(spark)) == ["prop_other.thing"]
