"""Click events in the model's columns, made from the sample tables.

The sample tables have no NULLs and no clickstream export, so this view derives
both: `bronze_view` is what cleaning an export would give, `raw_export` is the
export itself under its raw column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.columns import COLUMN_NAMES

# Host and path of a page's URL.
_PAGE = (
    "page_id",
    "url AS current_url",
    "regexp_extract(url, '^https?://([^/?#]+)', 1) AS host",
    "regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS pathname",
)

# How each model column follows from an event, its page, its
# customer and the customer's nation. A CASE without ELSE injects the NULLs.
_CLICK = (
    "CAST(event_id AS STRING) AS event_uuid",
    "event_type AS event_name",
    "ts AS event_timestamp",
    "CASE WHEN user_id % 50 <> 49 THEN concat('d', user_id) END AS distinct_id",
    "concat('p', user_id % 100) AS person_id",
    "CASE WHEN event_id % 3 = 0 THEN concat('ph', user_id) END AS posthog_user_id",
    "CASE WHEN event_id % 5 = 0 THEN concat('app', user_id) END AS app_user_id",
    "CASE WHEN event_id % 7 = 0 THEN c_name END AS prop_user_id",
    "CASE WHEN event_id % 4 <> 0 THEN concat(user_id, '-', CAST(ts AS DATE)) END AS session_id",
    "CASE WHEN event_id % 8 = 0 THEN concat('s', user_id) END AS prop_session_id",
    "pathname",
    "current_url",
    "host",
    "CASE WHEN event_id % 3 = 0 THEN 'canvas' END AS surface",
    "CASE user_id % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Desktop' END AS device_type",
    "CASE user_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' WHEN 2 THEN 'Firefox' END"
    " AS browser",
    "CASE WHEN user_id % 5 <> 0 THEN concat(100 + user_id % 7, '.10') END AS browser_version",
    "CASE WHEN user_id % 2 = 0 THEN 'Mac OS X' ELSE 'Windows' END AS os",
    "CASE WHEN user_id % 6 <> 0 THEN CAST(10 + user_id % 2 AS STRING) END AS os_version",
    "CASE WHEN user_id % 9 <> 0 THEN 'en-US' END AS browser_language",
    "CASE WHEN user_id % 11 <> 0 THEN n_name END AS country_name",
    "CASE WHEN user_id % 13 <> 0 THEN concat('N', n_nationkey) END AS country_code",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, joined to its page, its customer and the customer's nation.

    No side is broadcast by hint: pages and customers grow with the data, so
    Catalyst decides by their size. Customers join before nations because the
    size of a bare table is known, that of a join only guessed; a guess too high
    would shuffle the events. Beyond the threshold the join is a sort-merge, and
    AQE splits a user too hot for one of its tasks.

    Host and path are cut out once per page, before the join. Every event stays: where page ids
    have gaps, its page is NULL.
    """
    pages = table(spark, sf_dir, "pages")
    page_total = pages.agg(F.max("page_id") + 1).scalar()
    events = table(spark, sf_dir, "events").withColumn("page_id", F.col("event_id") % page_total)
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    return (
        events.join(pages.selectExpr(*_PAGE), "page_id", "left")
        .join(customers, events.user_id == customers.c_custkey, "left")
        .join(nations, customers.c_nationkey == nations.n_nationkey, "left")
        .selectExpr(*_CLICK)
    )


def raw_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view under raw column names, with columns the model drops or never names."""
    raw_names = {model: raw for raw, model in COLUMN_NAMES.items()}
    export = bronze_view(spark, sf_dir).withColumnsRenamed(raw_names)
    return export.withColumns(
        {
            "Unnamed: 0": F.col("uuid"),
            "prop_$lib": F.lit("web"),
            "prop_$viewport_width": (F.length("prop_$current_url") + 1000).cast("string"),
            "prop_credits_used": F.lit("0.5"),
            "prop_note": F.concat(F.lit('say "hi", '), F.col("event"), F.lit("\nbye")),
        }
    )
