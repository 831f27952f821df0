"""

    python bench_layout.py [copies]      prints one JSON line

Reads $BENCH_SF_DIR on local[$BENCH_CPUS] and writes below spark.checkpoint.dir.
The raw export is widened to 107 columns, as wide as the published one. With
BENCH_ONE_FILE=0 the runs that read the export as a single file are left out.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bench import local_session
from starflow import sample_clicks
from starflow.columns import TABLE_NAMES
from starflow.functions import user_id
from starflow.operators import clean, first_row_per_key
from starflow.plans import (
    RefreshConfig,
    build_gold,
    build_silver,
    gold_tables,
    ingest_bronze,
    run_refresh,
    silver_tables,
)
from starflow.plans.bronze import READINGS
from starflow.sources import read_csv, read_parquet, scratch_path, write_csv, write_parquet

RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONE_FILE = os.environ.get("BENCH_ONE_FILE", "1") == "1"
RAW_COLUMNS = 107


def timed(action: Callable[[], object]) -> float:
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 2)


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def stage_inputs(spark: SparkSession, sf_dir: str, copies: int, root: str) -> None:
    """The sample tables with `copies` times the events, under new event ids."""
    for name in ("pages", "customer", "nation"):
        sample_clicks.table(spark, sf_dir, name).write.parquet(f"{root}/{name}.parquet")
    events = sample_clicks.table(spark, sf_dir, "events")
    total = events.count()
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    repeated = (
        events.repartition(spark.sparkContext.defaultParallelism)
        .withColumn("copy", copy)
        .withColumn("event_id", F.col("event_id") + F.col("copy") * total)
        .drop("copy")
    )
    repeated.write.parquet(f"{root}/events.parquet")


def widened(export: DataFrame) -> DataFrame:
    """Pad to the published width; one padding column in four holds a value.

    Line breaks are taken out, so that the file can be read split as well as whole.
    """
    missing = RAW_COLUMNS - len(export.columns)
    return export.withColumn("prop_note", F.translate("prop_note", "\n", " ")).withColumns(
        {
            f"prop_extra_{i}": F.substring("uuid", 1, 4) if i % 4 == 0 else F.lit("")
            for i in range(missing)
        }
    )


def one_file_csv_layout(spark: SparkSession, raw: str, root: str) -> None:
    """The same tables by one-file CSV stages: a pass per type inference, count and table."""

    def inferred(path: str) -> DataFrame:
        spark.read.option("header", True).option("escape", '"').option("inferSchema", True).csv(
            path
        )
        return read_csv(spark, path, multiline=False)

    export = inferred(raw)
    export.count()
    for name, df in silver_tables(clean(export)).items():
        write_csv(df.coalesce(1), f"{root}/silver/{name}")
    gold = gold_tables({name: inferred(f"{root}/silver/{name}") for name in TABLE_NAMES})
    for name, df in gold.items():
        write_parquet(df.coalesce(1), f"{root}/gold/{name}")
    gold["fact_events"].count()


def time_one_file_ingest(spark: SparkSession, one_file: str, root: str) -> dict[str, float]:
    """One file read split, read whole, and read whole with its rows spread afterwards."""
    result = {
        "ingest_one_file_split_sec": timed(
            lambda: ingest_bronze(spark, one_file, f"{root}/bronze_split", "split")
        )
    }
    for label, spread in (("whole", False), ("spread", True)):
        staged = f"{root}/bronze_{label}"
        result[f"ingest_one_file_{label}_sec"] = timed(
            lambda staged=staged, spread=spread: ingest_bronze(
                spark, one_file, staged, "whole", spread=spread
            )
        )
        result[f"silver_from_one_file_{label}_sec"] = timed(
            lambda staged=staged: build_silver(spark, staged, f"{root}/silver")
        )
    return result


def main(copies: int) -> dict[str, object]:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    cores = spark.sparkContext.defaultParallelism
    root = scratch_path(spark, "layout")
    stage_inputs(spark, sf_dir, copies, f"{root}/tables")
    one_file, many_files, bronze = f"{root}/raw_one", f"{root}/raw_many", f"{root}/bronze"
    export = widened(sample_clicks.raw_export(spark, f"{root}/tables"))
    write_csv(export.repartition(4 * cores), many_files)
    result: dict[str, object] = {"rows": read_csv(spark, many_files).count()}
    result["ingest_many_files_sec"] = timed(lambda: ingest_bronze(spark, many_files, bronze))
    if ONE_FILE:
        write_csv(read_csv(spark, many_files).coalesce(1), one_file)
        result |= time_one_file_ingest(spark, one_file, root)

    events = clean(read_parquet(spark, bronze))
    silver, gold = f"{root}/silver", f"{root}/gold"
    result["silver_sec"] = timed(lambda: build_silver(spark, bronze, silver))
    result["silver_in_turn_sec"] = timed(
        lambda: build_silver(spark, bronze, silver, concurrent=False)
    )
    result["gold_sec"] = timed(lambda: build_gold(spark, silver, gold))
    result["gold_in_turn_sec"] = timed(lambda: build_gold(spark, silver, gold, concurrent=False))

    fact = silver_tables(events)["fact_events"]
    result["fact_sec"] = timed(lambda: write_parquet(fact, f"{root}/fact"))
    result["fact_one_task_sec"] = timed(lambda: write_parquet(fact.coalesce(1), f"{root}/fact1"))

    users = events.select(
        "distinct_id", "person_id", user_id().alias("user_id"), "event_timestamp", "event_uuid"
    )
    order = ["event_timestamp", "event_uuid"]
    by_window = Window.partitionBy("distinct_id").orderBy(*order)
    numbered = users.withColumn("rn", F.row_number().over(by_window)).filter("rn = 1")
    result["dim_user_min_struct_sec"] = timed(
        lambda: noop(first_row_per_key(users, ["distinct_id"], order))
    )
    result["dim_user_row_number_sec"] = timed(lambda: noop(numbered.drop("rn")))

    exports = [("many_files", many_files, "check")]
    if ONE_FILE:
        # An export with line breaks in its fields is read whole.
        exports += [(f"one_file_{reading}", one_file, reading) for reading in READINGS]
    for label, raw, reading in exports:
        config = RefreshConfig(
            raw, f"{root}/lake", "layout_bench", f"{root}/warehouse", reading=reading
        )
        result[f"refresh_{label}_sec"] = timed(
            lambda config=config: run_refresh(spark, config).collect()
        )
    if ONE_FILE:
        result["one_file_csv_layout_sec"] = timed(
            lambda: one_file_csv_layout(spark, one_file, f"{root}/one_file")
        )
    spark.stop()
    return {"metric": "layout", "copies": copies, "cores": cores, **result}


if __name__ == "__main__":
    print(json.dumps(main(int(sys.argv[1]) if len(sys.argv) > 1 else 10)))
