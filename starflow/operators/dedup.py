"""Deduplication that combines before it shuffles, so a hot key costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row deduplication; NULLs count as equal."""
    return df.distinct()


def first_row_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """One row per key: the first by `order_by`, NULLs last.

    Same rows as `row_number() = 1`, as an aggregate: the minimum of a struct is
    combined on the map side, so at most one row per key and task is shuffled,
    whatever the key's share of the data. A window gets there only where the
    optimizer turns the filter on its number into a limit before the shuffle.
    Rows that tie on `order_by` are ranked by their remaining columns, which
    makes the result independent of partitioning. Columns can have any names; a
    map column is an error, since maps have no order.
    """
    keys = list(keys)
    unordered = [f.name for f in df.schema if isinstance(f.dataType, MapType)]
    if unordered:
        raise ValueError(f"maps cannot be ordered, so no row is first: {', '.join(unordered)}")
    ranked = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in ranked]
    # By place and not by name: names may hold dots, or be those of the parts.
    parts = [part for c in ranked for part in (_column(c).isNull(), _column(c))]
    parts += [_column(c) for c in rest]
    place = {c: 2 * i + 1 for i, c in enumerate(ranked)}
    place |= {c: 2 * len(ranked) + i for i, c in enumerate(rest)}
    named = [part.alias(f"p{i}") for i, part in enumerate(parts)]
    grouped = df.groupBy(*[_column(c).alias(f"k{i}") for i, c in enumerate(keys)])
    # A key alone has no other column to rank by.
    first = grouped.agg(F.min(F.struct(*named)).alias("first")) if named else grouped.agg(F.lit(1))
    return first.select(
        *[
            F.col(f"k{keys.index(c)}" if c in keys else f"first.p{place[c]}").alias(c)
            for c in df.columns
        ]
    )


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
