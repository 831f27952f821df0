"""Substring dedup: words covered by a window of words that starts earlier, too, are removed.

Recompression (recompression.py) gives every window an anchor: a high-level symbol inside
it that follows from the window's words alone. Equal windows have equal anchors, so a window whose
anchor's name occurs once in the corpus is not repeated, and there are far fewer anchors than
windows. Only windows with a shared anchor are then compared with each other, by 128-bit
hashes of all their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.recompression import anchors, recompress
from starflow.llm.rows import blocks, documents, row_key, saved
from starflow.llm.words import Words

ROUNDS = 2


def _words_of(text: bytes) -> list[bytes]:
    return text.split()  # of bytes: at space and U+0009 to U+000D


def _anchored(words: Words, window: int, rounds: int):
    """Start, anchor's name and anchor's place of every window of a block."""
    hashes = words.hashes()
    n = len(hashes) - window + 1
    starts = np.flatnonzero(words.row[: max(n, 0)] == words.row[window - 1 :]) if n > 0 else np.empty(0, np.int64)
    levels = recompress(words, hashes, rounds)
    names, places = anchors(levels, starts, window)
    return hashes, starts, names, places


def _lists(values: np.ndarray, rows: np.ndarray, n_rows: int) -> pa.Array:
    """One list for each row; `rows` says whose each value is."""
    order = np.argsort(rows.astype(np.int32), kind="stable")
    ends = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n_rows))))
    lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(values[order]))
    return lists.cast(pa.list_(lists.type.value_type))


def _survey(window: int, rounds: int):
    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            words = Words(texts)
            _, starts, names, places = _anchored(words, window, rounds)
            _, once = np.unique(places, return_index=True)
            plain = [
                hashlib.sha256(b" ".join(_words_of(t.as_buffer().to_pybytes()))).hexdigest()
                for t in texts
            ]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "row": batch.column("row"),
                    "row2": batch.column("row2"),
                    "n_words": pa.array(words.count.astype(np.int64)),
                    "plain": pa.array(plain, pa.string()),
                    "names": _lists(
                        names[once].view(np.int64), words.row[starts[once]], len(texts)
                    ),
                }
            )

    return survey


def _shared(words: Words, batch: pa.RecordBatch, window: int, rounds: int):
    """Word hashes, and the starts of the windows whose anchor's name is shared."""
    hashes, starts, names, _ = _anchored(words, window, rounds)
    shared = np.unique(batch.column("shared").flatten().to_numpy(zero_copy_only=False))
    at = np.searchsorted(shared, names.view(np.int64))
    at[at == len(shared)] = 0
    return hashes, starts[shared[at] == names.view(np.int64)] if len(shared) else starts[:0]


def _windows(window: int, rounds: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            words = Words(texts)
            hashes, starts = _shared(words, batch, window, rounds)
            if not len(starts):
                continue
            first, at = words.runs(hashes, window)
            chosen = np.searchsorted(at, starts)
            second, _ = words.runs(words.hashes(2), window)
            rows = words.row[starts]
            index = pa.array(rows)
            yield pa.record_batch(
                {
                    "w1": pa.array(first[chosen].view(np.int64)),
                    "w2": pa.array(second[chosen].view(np.int64)),
                    "doc_id": batch.column("doc_id").take(index),
                    "row": batch.column("row").take(index),
                    "start": pa.array((starts - words.first[rows]).astype(np.int32)),
                }
            )

    return emit


def _removal(window: int, rounds: int, digest: bool):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            words = Words(texts)
            _, starts = _shared(words, batch, window, rounds)
            rows = words.row[starts]
            late = np.zeros(len(words.start) + 1, np.int64)
            late[starts] = 1
            firsts = batch.column("firsts")
            owner = np.repeat(np.arange(len(texts)), np.diff(firsts.offsets.to_numpy()))
            late[words.first[owner] + firsts.flatten().to_numpy(zero_copy_only=False)] = 0
            begins = np.flatnonzero(late)
            cover = np.zeros(len(late) + window, np.int64)
            np.add.at(cover, begins, 1)
            np.add.at(cover, begins + window, -1)
            gone = np.cumsum(cover)[: len(words.start)] > 0
            removed, kept = [], []
            for i, text in enumerate(texts):
                mask = ~gone[words.first[i] : words.first[i + 1]]
                data = b" ".join(compress(_words_of(text.as_buffer().to_pybytes()), mask))
                removed.append(len(mask) - int(mask.sum()))
                kept.append(hashlib.sha256(data).hexdigest() if digest else data.decode())
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "row": batch.column("row"),
                    "n_removed": pa.array(removed, pa.int64()),
                    "kept": pa.array(kept, pa.string()),
                }
            )

    return remove


def remove_repeats(
    docs: DataFrame, window: int = 20, rounds: int = ROUNDS, digest: bool = False
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of `docs` (doc_id, text).

    Words are runs of characters other than space and U+0009 to U+000D. Each word
    covered by a window of `window` consecutive words of one text, whose words also start
    earlier (in a smaller doc_id, or in the same document at an earlier place), is removed.
    All windows are judged on the input. `kept` is the other words joined by one space, or with
    `digest` the lowercase hex SHA-256 of that; NULL where no word of a text was taken out
    and texts are asked for, so that whole texts are not copied.

    Texts that equal an earlier document's are told by their hash and go no
    further: with `window` words or more, all their words are removed. Of
    the others, names of anchors are counted, combined before the shuffle; a name that
    very many documents share is a hot key of one join only, which AQE splits. Then each
    window hash finds its first occurrence by a minimum, combined before the shuffle, and the
    firsts go back to their documents. So no group of equal windows is ever gathered.

    `rounds` moves work only: 1 leaves more windows to compare, 3 more anchors to count.

    NULL and empty texts have no words. A row without doc_id is kept whole and takes no
    part. Rows that repeat a doc_id with other text are ordered by a hash of the text;
    identical rows count once and get equal results.
    """
    keyed = documents(docs).withColumns(
        {"row": row_key(), "row2": F.xxhash64(F.lit(1), F.coalesce("text", F.lit("")))}
    )
    surveyed = saved(
        keyed.mapInArrow(
            _survey(window, rounds),
            "doc_id long, row long, row2 long, n_words long, plain string, names array<long>",
        ),
        "anchors",
    )
    texts = (
        surveyed.filter("doc_id IS NOT NULL")
        .groupBy("row", "row2")
        .agg(F.min("doc_id").alias("first_doc"))
    )
    ids = saved(
        surveyed.select("doc_id", "row", "row2")
        .join(texts, ["row", "row2"])
        .filter("doc_id IS NOT NULL")
        .select("doc_id", "row", (F.col("doc_id") != F.col("first_doc")).alias("copy"))
        .distinct(),
        "copies",
    )
    originals = ids.filter("NOT copy").select("doc_id", "row")
    # Repeated identical rows have equal lists; one of them is enough.
    named = (
        surveyed.filter(F.size("names") > 0)
        .join(originals, ["doc_id", "row"])
        .groupBy("doc_id", "row")
        .agg(F.first("names").alias("names"))
        .select("row", F.explode("names").alias("name"))
    )
    # Written, so that the join has plain shuffles on both sides, which AQE can split.
    shared = saved(
        named.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name"), "names"
    )
    replies = saved(
        named.join(shared, "name").groupBy("row").agg(F.collect_set("name").alias("shared")),
        "shared",
    )
    suspects = originals.join(replies, "row")
    held = keyed.select("doc_id", "row", "text").join(suspects, ["doc_id", "row"])
    first = (
        held.mapInArrow(
            _windows(window, rounds), "w1 long, w2 long, doc_id long, row long, start int"
        )
        .groupBy("w1", "w2")
        .agg(F.min(F.struct("doc_id", "row", "start")).alias("at"))
        .groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.row").alias("row"))
        .agg(F.collect_list("at.start").alias("firsts"))
    )
    judged = (
        held.join(first, ["doc_id", "row"], "left")
        .withColumn("firsts", F.coalesce("firsts", F.array().cast("array<int>")))
        .mapInArrow(
            _removal(window, rounds, digest), "doc_id long, row long, n_removed long, kept string"
        )
        .dropDuplicates(["doc_id", "row"])
    )
    whole_copy = F.coalesce("copy", F.lit(False)) & (F.col("n_words") >= window)
    nothing = hashlib.sha256(b"").hexdigest() if digest else ""
    untouched = F.col("plain") if digest else F.lit(None).cast("string")
    return (
        surveyed.drop("names", "row2")
        .join(ids, ["doc_id", "row"], "left")
        .join(judged, ["doc_id", "row"], "left")
        .select(
            "doc_id",
            "n_words",
            F.when(whole_copy, F.col("n_words"))
            .otherwise(F.coalesce("n_removed", F.lit(0)))
            .alias("n_removed"),
            F.when(whole_copy, F.lit(nothing))
            .when(F.coalesce("n_removed", F.lit(0)) > 0, F.col("kept"))
            .otherwise(untouched)
            .alias("kept"),
        )
    )
