"""The published tables in Spark's catalog."""

from __future__ import annotations

import logging
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from starflow.columns import GOLD_TABLES, TABLE_NAMES
from starflow.sources.lake import for_each_table, read_parquet


log = logging.getLogger(__name__)

# Between a table's own folder and the folder of one load.
_LOADS = "/loads/"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_name(database: str, table: str) -> str:
    return f"{quoted(database)}.{quoted(table)}"


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database and its tables where they do not exist; keep them where they do."""
    where = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{where}")
    for table, columns in GOLD_TABLES.items():
        ddl = ", ".join(f"{quoted(name)} {type_name}" for name, type_name in columns.items())
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table_name(database, table)} ({ddl}) USING parquet"
        )


def truncate_table(spark: SparkSession, database: str, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table_name(database, table)}")


def table_location(spark: SparkSession, target: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {target}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def by_name(rows: DataFrame, fields: list[StructField], table: str) -> DataFrame:
    """The rows with a table's columns, matched by name in any order and case, and its types."""
    given = {name.lower(): name for name in rows.columns}
    known = {field.name.lower() for field in fields}
    if not known & set(given):
        raise ValueError(f"no column matches table {table}: {rows.columns}")
    absent = [field.name for field in fields if field.name.lower() not in given]
    extra = [name for name in rows.columns if name.lower() not in known]
    if absent or extra:
        log.warning("loading %s: NULL for %s, leaving out %s", table, absent, extra)
    return rows.select(
        *[
            (F.col(quoted(given[f.name.lower()])) if f.name.lower() in given else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in fields
        ]
    )


def load_table(spark: SparkSession, database: str, table: str, rows: DataFrame) -> None:
    """Replace a table's rows.

    The rows are written to a fresh folder beside the table's, and then the table is pointed
    there: until they are all written, and if writing fails, the table keeps its old
    rows. The folder it had before is left for readers that are still at it, and is
    emptied by the load after the next.

    Columns are matched by name, in any order and case. Columns the table has and the
    rows lack become NULL, columns the table lacks are left out; either is logged.
    """
    target = table_name(database, table)
    matched = by_name(rows, spark.table(target).schema.fields, table)
    now = table_location(spark, target)
    root, mark, _ = now.partition(_LOADS)
    fresh = f"{root}{_LOADS}{uuid4().hex}"
    matched.write.parquet(fresh)
    spark.sql(f"ALTER TABLE {target} SET LOCATION {literal(fresh)}")
    if mark:
        _remove_all_but(spark, f"{root}{_LOADS}".rstrip("/"), {now, fresh})


def _remove_all_but(spark: SparkSession, folder: str, kept: set[str]) -> None:
    """Remove the loads in `folder` that no table points to any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = {name.rstrip("/").rsplit("/", 1)[1] for name in kept}
    for status in files.listStatus(path):
        if status.getPath().getName() not in names:
            files.delete(status.getPath(), True)


def load_from_lake(
    spark: SparkSession, database: str, gold_root: str, concurrent: bool = True
) -> None:
    """Replace every table with the Parquet files under `gold_root`.

    They must have exactly the published columns: a missing key would load as NULL.
    All tables are looked at before the first is loaded.
    """
    gold = {table: read_parquet(spark, f"{gold_root}/{table}") for table in TABLE_NAMES}
    for table, rows in gold.items():
        if {name.lower() for name in rows.columns} != {name.lower() for name in GOLD_TABLES[table]}:
            raise ValueError(f"{table} has other columns than published: {rows.columns}")
    for_each_table(
        spark,
        TABLE_NAMES,
        lambda table: load_table(spark, database, table, gold[table]),
        concurrent,
    )


def warehouse_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {table: spark.table(table_name(database, table)) for table in TABLE_NAMES}
