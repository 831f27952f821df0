"""All published tables behind one pointer, so that readers never mix two loads.

A load writes its rows to fresh folders that nothing else touches, then a manifest: one row for each part of
each table, with its folder. The pointer is the location of one catalog table over the
manifest. Moving it is one metadata operation: before it, readers see every table as it
was, after it every table as it is now. A load that fails moves nothing. Parts that a load
does not replace, such as the facts of other dates, are carried over by name alone.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.columns import GOLD_TABLES
from starflow.sources.lake import for_each_table, write_parquet
from starflow.sources.warehouse import by_name, literal, quoted, table_location, table_name

MANIFEST = "published_parts"
_COLUMNS = "table_name string, part string, path string"

# The part of a table that is loaded as a whole.
WHOLE = ""


@dataclass(frozen=True)
class Part:
    """A table's rows in one folder; a table's parts have different names."""

    table: str
    part: str
    path: str


def create_snapshots(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database and its pointer, which points to an empty manifest, where they do not exist."""
    where = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{where}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table_name(database, MANIFEST)} ({_COLUMNS}) USING parquet")


def _root(spark: SparkSession, database: str) -> str:
    described = spark.sql(f"DESCRIBE DATABASE {quoted(database)}")
    return described.filter("info_name = 'Location'").first()["info_value"].rstrip("/")


def current_parts(spark: SparkSession, database: str) -> list[Part]:
    """The manifest that the pointer points to, read once. One row a part: tables and dates, not rows."""
    rows = spark.table(table_name(database, MANIFEST)).collect()
    return sorted((Part(r.table_name, r.part, r.path) for r in rows), key=lambda p: (p.table, p.part))


def publish(spark: SparkSession, database: str, parts: list[Part]) -> str:
    """Write a manifest of exactly these parts and move the pointer to it. Returns the manifest's folder."""
    names = [(p.table, p.part) for p in parts]
    if len(set(names)) < len(names):
        raise ValueError("a part is listed twice")
    folder = f"{_root(spark, database)}/manifests/{uuid4().hex}"
    rows = spark.createDataFrame([(p.table, p.part, p.path) for p in parts], _COLUMNS)
    rows.coalesce(1).write.parquet(folder)
    spark.sql(f"ALTER TABLE {table_name(database, MANIFEST)} SET LOCATION {literal(folder)}")
    spark.catalog.refreshTable(table_name(database, MANIFEST))
    return folder


def go_back(spark: SparkSession, database: str, manifest: str) -> None:
    """Point to an earlier manifest, as `publish` or `manifest_location` returned it."""
    spark.sql(f"ALTER TABLE {table_name(database, MANIFEST)} SET LOCATION {literal(manifest)}")
    spark.catalog.refreshTable(table_name(database, MANIFEST))


def manifest_location(spark: SparkSession, database: str) -> str:
    return table_location(spark, table_name(database, MANIFEST))


def _schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{quoted(n)} {kind}" for n, kind in GOLD_TABLES[table].items()))


def load_parts(
    spark: SparkSession,
    database: str,
    tables: Mapping[str, DataFrame],
    part: Mapping[str, str] | None = None,
    concurrent: bool = True,
) -> list[Part]:
    """Replace parts of tables, all or none, and return what is published then.

    `tables` has the rows by table, `part` the part's name where a table is loaded in parts. Columns are matched by name, as
    in `load_table`. All rows are written before the pointer moves. One load at a time: of two at once, the later pointer wins.
    """
    part = part or {}
    unknown = set(tables) - set(GOLD_TABLES)
    if unknown:
        raise ValueError(f"not published: {sorted(unknown)}")
    root = _root(spark, database)
    fresh = {
        name: Part(name, part.get(name, WHOLE), f"{root}/parts/{name}/{uuid4().hex}") for name in tables
    }
    for_each_table(
        spark,
        tables,
        lambda name: write_parquet(
            by_name(tables[name], _schema(name).fields, name), fresh[name].path, compression="snappy"
        ),
        concurrent,
    )
    replaced = {(p.table, p.part) for p in fresh.values()}
    kept = [p for p in current_parts(spark, database) if (p.table, p.part) not in replaced]
    parts = [*kept, *fresh.values()]
    publish(spark, database, parts)
    return parts


def published_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """Every published table as of one manifest: all of them from the same loads, whatever is published meanwhile."""
    parts = current_parts(spark, database)
    found = {}
    for name in GOLD_TABLES:
        paths = [p.path for p in parts if p.table == name]
        schema = _schema(name)
        found[name] = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return found


def remove_unpublished(spark: SparkSession, database: str, keep: list[str]) -> list[str]:
    """Remove folders of parts and manifests that neither the pointer nor the manifests in `keep` list.

    Not while a load runs, whose folders no manifest lists yet. Returns the removed folders.
    """
    root = _root(spark, database)
    manifests = {manifest_location(spark, database), *keep}
    listed = {r.path for m in manifests for r in spark.read.schema(_COLUMNS).parquet(m).select("path").collect()}
    held = {p.rstrip("/").rsplit("/", 1)[1] for p in manifests | listed}
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    removed = []
    for folder in ["manifests", *[f"parts/{name}" for name in GOLD_TABLES]]:
        at = path(f"{root}/{folder}")
        for status in files.listStatus(at) if files.exists(at) else ():
            if status.getPath().getName() not in held:
                files.delete(status.getPath(), True)
                removed.append(f"{root}/{folder}/{status.getPath().getName()}")
    return removed
