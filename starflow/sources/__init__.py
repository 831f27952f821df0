"""Sources and sinks: CSV, Parquet in the lake, and catalog tables."""

from starflow.sources.csv import one_record_per_line, read_csv, write_csv
from starflow.sources.lake import for_each_table, read_parquet, scratch_path, write_parquet
from starflow.sources.records import read_records
from starflow.sources.snapshots import (
    Part,
    create_snapshots,
    current_parts,
    go_back,
    load_parts,
    manifest_location,
    publish,
    published_tables,
    remove_unpublished,
)
from starflow.sources.warehouse import (
    create_tables,
    load_from_lake,
    load_table,
    table_name,
    truncate_table,
    warehouse_tables,
)

__all__ = [
    "Part",
    "create_snapshots",
    "create_tables",
    "current_parts",
    "for_each_table",
    "go_back",
    "load_from_lake",
    "load_parts",
    "load_table",
    "manifest_location",
    "one_record_per_line",
    "publish",
    "published_tables",
    "read_csv",
    "read_parquet",
    "read_records",
    "remove_unpublished",
    "scratch_path",
    "table_name",
    "truncate_table",
    "warehouse_tables",
    "write_csv",
    "write_parquet",
]
