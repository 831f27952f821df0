"""Raw export to bronze: the only pass over CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starflow.sources import (
    one_record_per_line,
    read_csv,
    read_parquet,
    read_records,
    write_parquet,
)

READINGS = ("check", "split", "records", "whole")


def ingest_bronze(
    spark: SparkSession,
    raw_path: str | list[str],
    bronze_path: str,
    reading: str = "check",
    check_headers: bool = True,
    spread: bool = False,
    max_records_per_file: int = 0,
) -> DataFrame:
    """Stage the raw export as Parquet, unchanged, and return it.

    CSV is read row by row and whole; from here on each table reads only its own
    columns, in batches.

    reading  how files become tasks; the same for any number of files and cores.
             `split` cuts files wherever lines end, which is right where no field
             holds a line break. `records` cuts them where records end, found by
             counting quotes, and fails where quotes do not enclose whole fields.
             `whole` gives each file to one task. `check` looks at every line of the
             whole input, in parallel, and reads split if all records are lines, by
             records if all can be vouched for, and otherwise whole.
    spread   deal the rows out evenly by a shuffle before they are written.

    Only an export with stray quotes or mixed line ends cannot be split: one large file of
    that kind is one task, so it should come as many files of moderate size.
    """
    if reading not in READINGS:
        raise ValueError(f"reading is one of {', '.join(READINGS)}, not {reading!r}")
    split = reading == "split" or reading == "check" and one_record_per_line(spark, raw_path)
    raw = None
    if not split and reading in ("check", "records"):
        raw = read_records(spark, raw_path, check_headers=check_headers)
        if raw is None and reading == "records":
            raise ValueError("quotes do not enclose whole fields, or line ends differ")
    if raw is None:
        raw = read_csv(spark, raw_path, multiline=not split, check_headers=check_headers)
    if spread:
        raw = raw.hint("rebalance")
    write_parquet(raw, bronze_path, max_records_per_file=max_records_per_file)
    return read_parquet(spark, bronze_path)
