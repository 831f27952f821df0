"""Rows in and out of the operators: written intermediate tables, row keys, bounded blocks."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.sources import read_parquet, scratch_path, write_parquet

# Bytes of text that one block of array work covers. A longer text is a block by itself.
BLOCK_BYTES = 1 << 20


def saved(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the cluster's shared folder and read back.

    Cuts the lineage: an executor lost later costs a read, not the work so far.
    """
    path = scratch_path(df.sparkSession, label)
    write_parquet(df, path)
    return read_parquet(df.sparkSession, path)


def row_key(text: str = "text") -> Column:
    """Tells rows that share a doc_id apart by their text. Never NULL."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only what the operators read, so that other columns can have any name."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def plainly_named(df: DataFrame) -> DataFrame:
    """The same columns as c0, c1 and so on, since tasks cannot be given names with dots."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.LargeStringArray]]:
    """Slices of the batches that hold about `size` bytes of text, with the text's
    NULLs as empty strings, so that memory follows the block and not the batch."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, length in enumerate(lengths):
            if held and held + length > size:
                yield batch.slice(start, row - start), texts.slice(start, row - start)
                start, held = row, 0
            held += int(length)
        if start < len(lengths):
            yield batch.slice(start), texts.slice(start)


def held_by_process(key: str, make):
    """What `make` gives, made once in a worker process and kept there for later tasks."""
    name = "starflow_worker_state"
    held = vars(sys.modules.setdefault(name, types.ModuleType(name))).setdefault("held", {})
    if key not in held:
        held[key] = make()
    return held[key]


def let_go() -> None:
    """Frees what other operators' tasks have kept in this worker process, which Spark uses again for any operator. Whoever
    kept something makes it anew."""
    vars(sys.modules.get("starflow_worker_state") or types.ModuleType("none")).pop("held", None)
    pa.default_memory_pool().release_unused()


class Lately(dict):
    """What was looked up lately: when it is full, what was not used since the last time goes."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is not None:
            self[key] = value
        return value

    def tidy(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


def per_distinct(lists: pa.Array, ids_of) -> tuple[pa.LargeListArray, pa.DictionaryArray]:
    """Lists of strings to lists of what `ids_of` gives for each distinct string, 4-byte numbers in bytes, one after
    the other; and all strings as places among the distinct ones."""
    held = lists.flatten().dictionary_encode()
    own = ids_of(held.dictionary.to_pylist())
    sizes = np.array([len(ids) // 4 for ids in own], np.int64)
    flat = np.frombuffer(b"".join(own), np.int32)
    starts = np.cumsum(sizes) - sizes
    place = held.indices.to_numpy(zero_copy_only=False)
    each = sizes[place]
    ends = np.concatenate(([0], np.cumsum(each)))
    ids = flat[np.repeat(starts[place] - ends[:-1], each) + np.arange(ends[-1])]
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
    return pa.LargeListArray.from_arrays(pa.array(ends[bounds]), pa.array(ids, pa.int32())), held
