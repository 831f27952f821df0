"""Parquet tables in the lake, and scratch folders every executor can reach."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str, file_pattern: str = "*.parquet") -> DataFrame:
    """A lake table, reading only the files whose name matches.

    The schema comes from a file's footer rather than from the caller, so that a
    table whose write failed half-way is an error and not an empty table.
    """
    return spark.read.option("pathGlobFilter", file_pattern).parquet(path)


def write_parquet(
    df: DataFrame,
    path: str,
    compression: str = "zstd",
    max_records_per_file: int = 0,
) -> None:
    """Overwrite `path`, one file per task.

    Nothing is coalesced: a single output file would pull the scan and the key
    hashing of the whole table into one task. Dimensions come out of a shuffle
    whose partitions AQE has already merged to a sensible size; the fact table
    keeps the scan's splits.
    """
    (
        df.write.mode("overwrite")
        .option("compression", compression)
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(path)
    )


def for_each_table(
    spark: SparkSession,
    names: Iterable[str],
    action: Callable[[str], None],
    concurrent: bool = True,
) -> None:
    """Run `action(name)`, a job that reads and writes one table, for every table.

    The tables are independent. Submitted together, the tasks of one fill the
    slots that the last tasks of another leave idle. The first failure is raised
    after the running jobs have ended.
    """
    if not concurrent:
        for name in names:
            action(name)
        return
    with ThreadPoolExecutor() as pool:
        # One wrapper per job: each carries its own copy of the local properties.
        jobs = [pool.submit(inheritable_thread_target(spark)(action), name) for name in names]
    for job in jobs:
        job.result()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder the cluster names in spark.checkpoint.dir.

    Where that is unset, under the warehouse, which every session has and all
    executors share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{base.rstrip('/')}/starflow/{label}-{uuid4().hex}"
