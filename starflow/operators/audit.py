"""Checks of what was built: keys that collide, values that do not parse, rows that went missing.

All of them combine before they shuffle, and return rows only where something is wrong or one
row a check.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.columns import DECLARED_TYPES
from starflow.functions import declared, key_texts
from starflow.functions.keys import KEY_LENGTH
from starflow.operators.cleaning import _quoted

# ---------------------------------------------------------------------------
# Keys.


def collisions(rows: DataFrame, names: list[str], key: Column, text: Column) -> DataFrame:
    """(names, key, smallest, largest) of keys that stand for more than one text, with the least and the greatest of those.

    Two texts a key and task are shuffled at most, however often a key occurs. A NULL key stands for nothing.
    """
    found = rows.select(*names, key.alias("key"), text.alias("text")).filter("key IS NOT NULL").groupBy(*names, "key")
    return found.agg(F.min("text").alias("smallest"), F.max("text").alias("largest")).filter("smallest <> largest")


def key_collisions(events: DataFrame, length: int = KEY_LENGTH) -> DataFrame:
    """(key_name, key, smallest, largest): surrogate keys that two different natural keys share, of all five kinds, in one pass.

    `length` is how many characters of the hash make a key. Where it is the published one, a row here is a pair of dimension
    rows that facts cannot tell apart. NULLs and the texts that stand for them are one natural key.
    """
    texts = F.array(*[F.struct(F.lit(n).alias("key_name"), t.alias("text")) for n, t in key_texts().items()])
    natural = events.select(F.explode(texts).alias("k")).select("k.*")
    return collisions(natural, ["key_name"], F.substring(F.md5("text"), 1, length), F.col("text"))


# ---------------------------------------------------------------------------
# Values that do not parse.

RESCUED = "rescued"


def cast_rescuing(
    df: DataFrame, types: Mapping[str, str] = DECLARED_TYPES, zone: str = "UTC", rescued: str = RESCUED
) -> DataFrame:
    """`cast_declared`, and what it made NULL: `rescued` has the column's name and the text of each value that did not
    parse, in order of the columns, or NULL if all did. Texts of blanks only count as no value."""
    if rescued.lower() in {name.lower() for name in df.columns}:
        raise ValueError(f"there is a column {rescued}")
    text = {f.name.lower(): f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    casts = {text[n.lower()]: declared(F.col(_quoted(text[n.lower()])), kind, zone) for n, kind in types.items() if n.lower() in text}
    if not casts:
        return df.withColumn(rescued, F.lit(None).cast("array<struct<column:string,text:string>>"))
    lost = [
        F.when(
            cast.isNull() & (F.trim(F.col(_quoted(name))) != ""),
            F.struct(F.lit(name).alias("column"), F.col(_quoted(name)).alias("text")),
        )
        for name, cast in casts.items()
    ]
    found = F.array_compact(F.array(*lost))
    return df.withColumns({rescued: F.when(F.size(found) > 0, found), **casts})


def rescued_values(df: DataFrame, keep: list[str], rescued: str = RESCUED) -> DataFrame:
    """A row for each rescued value: the columns to `keep`, the column it was in, and its text."""
    return df.select(*keep, F.explode(rescued).alias("r")).select(*keep, F.col("r.column").alias("column_name"), "r.text")


def rescued_counts(df: DataFrame, rescued: str = RESCUED) -> DataFrame:
    """(column_name, n, smallest, largest) of the columns that hold values which did not parse."""
    return (
        rescued_values(df, [], rescued)
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n"), F.min("text").alias("smallest"), F.max("text").alias("largest"))
    )


# ---------------------------------------------------------------------------
# Rows that went missing.


def same_rows(name: str, expected: DataFrame, found: DataFrame) -> DataFrame:
    """One row (check_name, expected, found): the numbers of rows of two tables, from footers where they are Parquet."""
    a, b = (df.agg(F.count(F.lit(1)).alias(n)) for df, n in ((expected, "expected"), (found, "found")))
    return a.crossJoin(b).select(F.lit(name).alias("check_name"), "expected", "found")  # one row each


def keys_found(name: str, facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """One row (check_name, expected, found): how many different keys the facts have, and how many of them the dimension."""
    held = dimension.select(F.col(key).alias("held")).distinct()
    keys = facts.select(key).filter(F.col(key).isNotNull()).distinct()
    return keys.join(held, F.col(key) == F.col("held"), "left").agg(
        F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("expected"), F.count("held").alias("found")
    )


def all_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


class Mismatch(Exception):
    """A check found other rows than expected."""


def fail_on_mismatch(report: DataFrame) -> None:
    """Raise `Mismatch` with every check of a report (check_name, expected, found) that does not agree."""
    wrong = report.filter(~F.col("expected").eqNullSafe(F.col("found"))).orderBy("check_name").collect()
    if wrong:
        raise Mismatch("; ".join(f"{r.check_name}: expected {r.expected}, found {r.found}" for r in wrong))
