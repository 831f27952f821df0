"""Line dedup: who holds a repeated line first, found by one range partitioning of hashes."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starflow.llm.rows import documents, let_go, plainly_named, row_key, saved, unused

BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: str) -> bytes:
    """What has to agree for two lines to be the same: blanks at both ends and the case
    of A-Z don't count."""
    return line.strip(BLANKS).encode().lower()


def _line_rows(least: int):
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            digests, owners, positions = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for position, line in enumerate((text or "").split("\n")):
                    if len(line) >= least and len(line.strip(BLANKS)) >= least:
                        digests.append(hashlib.blake2b(line_key(line), digest_size=16).digest())
                        owners.append(i)
                        positions.append(position)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            owners = pa.array(owners, pa.int32())
            yield pa.record_batch(
                {
                    "h1": pa.array(halves[:, 0]),
                    "h2": pa.array(halves[:, 1]),
                    "doc_id": batch.column("doc_id").take(owners),
                    "row": batch.column("row").take(owners),
                    "pos": pa.array(positions, pa.int32()),
                }
            )

    return explode


_JUDGED = "kind string, part int, h1 long, h2 long, doc_id long, row long, pos int, whole boolean"


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams one sorted range. Emits the lines to drop; the lines of the first document of the
    range's first key, which may have begun in an earlier range, as `open`; and one `edge`
    row at either end of the range."""
    let_go()
    part = TaskContext.get().partitionId()
    last = None  # key and owner of the run that the batch before ended in
    runs = 0
    opened = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc, row, pos = (batch.column(c).to_numpy() for c in ("h1", "h2", "doc_id", "row", "pos"))
        begins = np.ones(len(h1), bool)
        begins[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if last is not None and (h1[0], h2[0]) == last[:2]:
            begins[0] = False
        run = np.cumsum(begins)
        owners = np.concatenate(([last[2] if last else 0], doc[begins]))
        owner = owners[run]
        run = run + runs
        runs = int(run[-1])
        if opened is None:
            opened = (int(h1[0]), int(h2[0]), int(doc[0]))
        last = (int(h1[-1]), int(h2[-1]), int(owner[-1]))
        for kind, mask in (("drop", doc != owner), ("open", (run == 1) & (doc == owner))):
            at = np.flatnonzero(mask)
            if len(at):
                yield _judged(kind, part, h1[at], h2[at], doc[at], row[at], pos[at], False)
    if last is not None:
        for kind, (a, b, owner) in (("first", opened), ("last", last)):
            one = [np.array([x], np.int64) for x in (a, b, owner, 0)]
            yield _judged(kind, part, *one, np.array([0], np.int32), runs == 1)


def _judged(kind, part, h1, h2, doc, row, pos, whole) -> pa.RecordBatch:
    n = len(h1)
    return pa.record_batch(
        {
            "kind": pa.array([kind] * n, pa.string()),
            "part": pa.array(np.full(n, part, np.int32)),
            "h1": pa.array(h1),
            "h2": pa.array(h2),
            "doc_id": pa.array(doc),
            "row": pa.array(row),
            "pos": pa.array(pos, pa.int32()),
            "whole": pa.array(np.full(n, whole)),
        }
    )


def _continued(edges: list) -> list[tuple[int, int]]:
    """(range, owner) of each range whose first key began in an earlier range."""
    ends: dict[int, dict] = {}
    for edge in edges:
        ends.setdefault(edge["part"], {})[edge["kind"]] = edge
    found, before = [], None
    for part in sorted(ends):
        first, last = ends[part]["first"], ends[part]["last"]
        owner = last["doc_id"]
        if before and before[:2] == (first["h1"], first["h2"]):
            found.append((part, before[2]))
            if first["whole"]:
                owner = before[2]
        before = (last["h1"], last["h2"], owner)
    return found


def repeated_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """(doc_id, row, pos) of each line whose key of at least `least` characters an earlier
    document holds too; `row` tells rows of one doc_id apart."""
    spark = docs.sparkSession
    keyed = documents(docs).withColumn("row", row_key()).filter("doc_id IS NOT NULL")
    lines = saved(
        keyed.mapInArrow(_line_rows(least), "h1 long, h2 long, doc_id long, row long, pos int"),
        "lines",
    )
    order = ["h1", "h2", "doc_id", "row", "pos"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    judged = saved(
        lines.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_first_occurrences, _JUDGED),
        "judged",
    )
    # At most two rows a range come to the driver, however many lines there are.
    edges = judged.filter("kind IN ('first', 'last')").collect()
    earlier = spark.createDataFrame(_continued(edges), "part int, owner long")
    late = (
        judged.filter("kind = 'open'")
        .join(F.broadcast(earlier), "part")
        .filter("doc_id <> owner")
    )
    columns = ["doc_id", "row", "pos"]
    return judged.filter("kind = 'drop'").select(*columns).union(late.select(*columns))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        dropped, maps = [], []
        for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("gone").to_pylist()):
            keep = np.ones(n, np.uint8)
            keep[gone or []] = 0
            dropped.append(n - int(keep.sum()))
            maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "row": batch.column("row"),
                "n_lines": batch.column("n_lines"),
                "n_dropped": pa.array(dropped, pa.int64()),
                "keep": pa.array(maps, pa.binary()),
            }
        )


def line_bitmaps(docs: DataFrame, least: int = 10) -> DataFrame:
    """(doc_id, row, n_lines, n_dropped, keep) of every document; no text.

    Texts are split at line feeds; a NULL or empty text is one empty line. Lines whose key
    has at least `least` characters and is held by two or more documents stay only in the
    smallest doc_id among them, however often they occur there. `keep` has a bit for each
    line, 1 where it stays, least significant first, compressed with zlib.

    Hashes of keys, 128 bits, are dealt out by ranges of (hash, doc_id, position), so a line that a third
    of the documents hold is spread over as many tasks as it needs. Each task streams
    its sorted range and knows the first document of every key that begins in it; for the one
    key that may have begun earlier, the ends of the ranges tell.

    Rows that share a doc_id count as one document; `row` tells their texts apart, and
    identical rows give one result row. A row without doc_id gets none.
    """
    keyed = documents(docs).withColumn("row", row_key()).filter("doc_id IS NOT NULL")
    n_lines = F.coalesce(
        F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))), F.lit(0)
    )
    held = keyed.select("doc_id", "row", (n_lines + 1).cast("int").alias("n_lines")).distinct()
    gone = (
        repeated_lines(docs, least)
        .groupBy("doc_id", "row")
        .agg(F.collect_set("pos").alias("gone"))
    )
    return held.join(gone, ["doc_id", "row"], "left").mapInArrow(
        _bitmaps, "doc_id long, row long, n_lines int, n_dropped long, keep binary"
    )


def kept_text(text: str | None, keep: bytes | None) -> str:
    """The lines of a text whose bit is set; the whole text where there is no bitmap."""
    if keep is None:
        return text or ""
    lines = (text or "").split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    return "\n".join(line for line, bit in zip(lines, bits) if bit)


def with_bitmaps(docs: DataFrame, least: int = 10, keep: str = "keep") -> DataFrame:
    """All columns of `docs`, which has doc_id and text, and each row's bitmap as another, `keep`.
    It is NULL for a row without doc_id, which is kept whole."""
    doc, row = unused(docs, "of_doc"), unused(docs, "of_row")
    maps = line_bitmaps(docs, least).select(
        F.col("doc_id").alias(doc), F.col("row").alias(row), F.col("keep").alias(keep)
    )
    return docs.join(maps, (docs["doc_id"] == maps[doc]) & (row_key() == maps[row]), "left").drop(
        doc, row
    )


def bitmap_counts(keep: bytes | None, text: str | None) -> tuple[int, int]:
    """Lines of a text, and how many of them its bitmap drops."""
    lines = (text or "").count("\n") + 1
    if keep is None:
        return lines, 0
    return lines, lines - int(np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8)).sum())


def _only_kept(text: int, keep: int):
    """Cuts the texts in one column down by the bitmaps in another, which goes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            texts, maps = batch.column(text).to_pylist(), batch.column(keep).to_pylist()
            kept = [None if t is None else kept_text(t, bits) for t, bits in zip(texts, maps)]
            cut_down = batch.set_column(text, batch.schema.names[text], pa.array(kept, pa.string()))
            yield cut_down.remove_column(keep)

    return cut


def without_repeated_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """`docs`, of which doc_id and text are columns, with texts cut down to the lines they keep.
    A NULL text stays NULL."""
    named = plainly_named(with_bitmaps(docs, least, unused(docs, "keep")))
    keep = len(docs.columns)
    kept = named.mapInArrow(
        _only_kept(docs.columns.index("text"), keep), StructType(named.schema.fields[:keep])
    )
    return kept.toDF(*docs.columns)
