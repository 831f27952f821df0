"""Row counts as DataFrames; the caller decides when to run them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    """One row, one column `n`."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and its number of rows."""
    counts = [
        row_count(df).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
