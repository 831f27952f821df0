from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from starflow import functions as fn
from starflow.columns import DEVICE_COLUMNS

# Keys of absent natural keys, which every implementation must give.
KEYS_OF_NOTHING = {
    "user": None,
    "device": "88572c7603bd2bb7",
    "geo": "696b031073e74bf2",
    "session": "37a6259cc0c1dae2",
    "page": "b99834bc19bbad24",
}
INPUTS = (
    "distinct_id",
    *DEVICE_COLUMNS,
    "country_code",
    "session_id",
    "prop_session_id",
    "host",
    "pathname",
)


def keys(spark, **values):
    schema = ", ".join(f"{name} string" for name in INPUTS)
    df = spark.createDataFrame([tuple(values.get(name) for name in INPUTS)], schema)
    return (
        df.select(
            fn.user_key().alias("user"),
            fn.device_key().alias("device"),
            fn.geo_key().alias("geo"),
            fn.session_key().alias("session"),
            fn.page_key().alias("page"),
        )
        .first()
        .asDict()
    )


def digest(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()[:16]


def test_keys_of_absent_values(spark):
    assert keys(spark) == KEYS_OF_NOTHING


def test_keys_hash_the_text_as_written(spark):
    row = keys(
        spark,
        distinct_id="007",
        device_type="Mobile",
        browser_version="17.10",
        country_code="DE",
        session_id="1e5",
        host="münchen.example",
        pathname="/a b",
    )
    assert row == {
        "user": digest("007"),
        "device": digest("Mobile||17.10|||"),
        "geo": digest("DE"),
        "session": digest("1e5"),
        "page": digest("münchen.example|/a b"),
    }


def test_session_falls_back_to_the_second_id(spark):
    assert keys(spark, prop_session_id="s2")["session"] == digest("s2")
    assert keys(spark, session_id="s1", prop_session_id="s2")["session"] == digest("s1")


def test_sentinels_collide_with_real_values(spark):
    assert keys(spark, session_id="null")["session"] == KEYS_OF_NOTHING["session"]
    assert keys(spark, country_code="UNKNOWN")["geo"] == KEYS_OF_NOTHING["geo"]
    assert keys(spark, host="", pathname="")["page"] == KEYS_OF_NOTHING["page"]
    assert keys(spark, host="a|b")["page"] == digest("a|b|")
    assert keys(spark, host="a|b", pathname="c") == {
        **KEYS_OF_NOTHING,
        "page": keys(spark, host="a", pathname="b|c")["page"],
    }


def test_numeric_inputs_do_not_break_under_ansi(spark):
    df = spark.createDataFrame([(1, None, "x")], "posthog_user_id int, app_user_id int, prop_user_id string")
    assert df.select(fn.user_id()).first()[0] == "1"
    numbers = spark.range(1).select(F.lit(1.5).alias("host"), F.lit(None).cast("int").alias("pathname"))
    assert numbers.select(fn.page_key()).first()[0] == digest("1.5|")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-03-10 02:30:00", "2024-03-10 02:30:00"),
        ("2024-03-10T02:30", "2024-03-10 02:30:00"),
        ("2025-09-01 10:00:00 Europe/Paris", "2025-09-01 08:00:00"),
        ("2025-09-01 10:00:00.123456+00:00", "2025-09-01 10:00:00.123456"),
        ("2025-09-01T10:00:00Z", "2025-09-01 10:00:00"),
        ("2025-09-01T10:00:00.5+02:00", "2025-09-01 08:00:00.5"),
        ("2025-09-01", "2025-09-01 00:00:00"),
        ("not a time", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, expected, zone):
    """In any session zone, over a time that one of them skips too."""
    df = spark.createDataFrame([(text,)], "t string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = df.select(F.unix_micros(fn.parse_timestamp("t"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    found = spark.range(1).select(F.timestamp_micros(F.lit(micros).cast("long")).cast("string"))
    assert found.first()[0] == expected


def test_times_without_offset_are_in_the_zone_asked_for(spark):
    df = spark.createDataFrame([("2025-09-01 10:00:00",)], "t string")
    parsed = df.select(fn.parse_timestamp("t", "America/New_York").cast("string"))
    assert parsed.first()[0] == "2025-09-01 14:00:00"


def test_a_time_is_parsed_once_however_it_is_placed_in_its_zone(spark):
    plan = spark.createDataFrame([("x",)], "t string").select(fn.parse_timestamp("t", "Europe/Berlin").alias("p"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().lower().count("try_cast") <= 1


@pytest.mark.parametrize("session", ["UTC", "America/New_York"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Pacific/Apia", "+05:30"])
def test_at_zone_is_what_its_fields_say(spark, session, zone):
    times = ["2024-03-10 02:30:00.000001", "2024-11-03 01:30:00", "1969-12-31 23:59:59.999999", "1883-11-18 12:00:00",
             "0001-01-01 00:00:00", "2011-12-30 10:00:00", "+40000-01-01 00:00:00", "-0044-03-15 12:00:00.5", None]
    local = F.col("t").cast("timestamp_ntz")
    fields = [F.date_part(F.lit(f), local).cast("int") for f in ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE")]
    want = F.make_timestamp(*fields, F.date_part(F.lit("SECOND"), local), F.lit(zone))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        df = spark.createDataFrame([(t,) for t in times], "t string")
        got = df.select(F.unix_micros(fn.at_zone(local, zone)), F.unix_micros(want)).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert all(a == b for a, b in got) and sum(a is None for a, _ in got) == 1
