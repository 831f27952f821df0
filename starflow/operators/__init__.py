"""Operators: functions from DataFrame to DataFrame. None of them runs a job."""

from starflow.operators.audit import (
    Mismatch,
    cast_rescuing,
    collisions,
    fail_on_mismatch,
    key_collisions,
    rescued_counts,
    rescued_values,
)
from starflow.operators.cleaning import (
    cast_declared,
    clean,
    drop_columns,
    rename_columns,
    require_columns,
    unexpected_columns,
)
from starflow.operators.counting import row_count, table_counts
from starflow.operators.dedup import distinct_rows, first_row_per_key

__all__ = [
    "Mismatch",
    "cast_rescuing",
    "collisions",
    "fail_on_mismatch",
    "key_collisions",
    "rescued_counts",
    "rescued_values",
    "cast_declared",
    "clean",
    "distinct_rows",
    "drop_columns",
    "first_row_per_key",
    "rename_columns",
    "require_columns",
    "row_count",
    "table_counts",
    "unexpected_columns",
]
