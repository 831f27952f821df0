"""From the raw export's columns to the model's. Narrow: one projection, no shuffle."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.columns import COLUMN_NAMES, DECLARED_TYPES, SILVER_INPUTS, UNUSED_COLUMNS
from starflow.functions import declared


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns, ignoring absent ones."""
    return df.drop(*names)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename all columns at once, ignoring absent ones.

    A name that two columns would then hold would make every later reference
    ambiguous, so that is refused here.
    """
    new_names = {old.lower(): new for old, new in mapping.items()}
    names = [new_names.get(name.lower(), name) for name in df.columns]
    repeats = Counter(name.lower() for name in names)
    clashes = sorted(name for name, n in repeats.items() if n > 1)
    if clashes:
        raise ValueError(f"renaming would repeat column names: {clashes}")
    return df.toDF(*names)


def cast_declared(
    df: DataFrame, types: Mapping[str, str] = DECLARED_TYPES, zone: str = "UTC"
) -> DataFrame:
    """Cast text columns to their declared types by name; unparsable text becomes NULL.

    Timestamps without an offset are in `zone`.

    Columns that are absent, or typed by their source already, stay as they are.
    """
    text = {f.name.lower(): f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    casts = {
        text[name.lower()]: declared(F.col(_quoted(text[name.lower()])), type_name, zone)
        for name, type_name in types.items()
        if name.lower() in text
    }
    return df.withColumns(casts) if casts else df


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The same DataFrame, or one error that lists every missing column."""
    present = {name.lower() for name in df.columns}
    missing = sorted({name for name in names if name.lower() not in present})
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def unexpected_columns(df: DataFrame) -> list[str]:
    """Raw columns the model neither drops nor uses, in file order."""
    known = {name.lower() for name in (*UNUSED_COLUMNS, *COLUMN_NAMES, "distinct_id", "person_id")}
    return [name for name in df.columns if name.lower() not in known]


def clean(raw: DataFrame, zone: str = "UTC") -> DataFrame:
    """Raw export columns to model columns, typed, checked for what silver needs."""
    events = rename_columns(drop_columns(raw, UNUSED_COLUMNS), COLUMN_NAMES)
    needed = [name for names in SILVER_INPUTS.values() for name in names]
    return cast_declared(require_columns(events, needed), zone=zone)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
