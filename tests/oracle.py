"""Runs oracle SQL in DuckDB over the same Parquet tables, and compares rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")
SMALL = str(TESTDATA / "sf0.001")
MEDIUM = str(TESTDATA / "sf0.01")


def oracle(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    result = con.sql(sql)
    return _sorted_by_name(result.columns, result.fetchall())


def rows_of(df) -> tuple[list[str], Counter]:
    return _sorted_by_name(df.columns, [tuple(r) for r in df.collect()])


def _sorted_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)
