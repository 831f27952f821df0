"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

An n-gram's feature is 1 where the text holds it, times the log ratio of how often
toxic and other texts hold it (both smoothed). A logistic regression over these features, kept
close to plain naive Bayes by a penalty, gives the weights. Scoring adds up the weights of
a whole text's distinct n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from starflow.llm.rows import blocks, documents, let_go, plainly_named, saved

ORDERS = (3, 4, 5)
_BITS = 18
# Bytes of text whose n-grams are held at once, three of 8 bytes each for a byte of text, several times over.
_TEXT_BLOCK = 1 << 18


def _flat(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, A-Z lower-cased, and where each text begins and ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = texts.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    return lower[held[offsets[0] : offsets[-1]]], offsets - offsets[0]


def ngram_buckets(data: np.ndarray, ends: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each byte, and a mask of those that lie in one text."""
    n = max(len(data) - order + 1, 0)
    hashed = np.full(n, order, np.uint32)
    for j in range(order):
        hashed = hashed * np.uint32(0x01000193) + data[j : j + n]
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    inside = np.ones(len(data) + order, bool)
    for j in range(1, order):
        # A text shorter than the n-gram hides only places whose n-gram leaves their text anyway.
        inside[(ends - j)[ends >= j]] = False
    return (hashed >> np.uint32(32 - _BITS)).astype(np.int64), inside[:n]


def _held(texts: pa.LargeStringArray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct n-grams of each text whose bucket is wanted."""
    data, row_at = _flat(texts)
    found = []
    for order in ORDERS:
        buckets, inside = ngram_buckets(data, row_at[1:], order)
        at = np.flatnonzero(wanted.take(buckets) & inside)
        rows = np.searchsorted(row_at, at, side="right") - 1
        found.append(rows << _BITS | buckets[at])
    both = np.unique(np.concatenate(found))
    return both >> _BITS, both & ((1 << _BITS) - 1)


@dataclass
class Model:
    """Weight of each bucket, and of the text itself."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.LargeStringArray) -> np.ndarray:
        rows, buckets = _held(texts, self.weights != 0)
        total = np.bincount(rows, self.weights[buckets], minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of either label hold each bucket."""
    counts = np.zeros((2, 1 << _BITS), np.int64)
    everything = np.ones(1 << _BITS, bool)
    let_go()
    for batch, texts in blocks(batches, size=_TEXT_BLOCK):
        labels = batch.column("label").to_numpy()
        rows, buckets = _held(texts, everything)
        for label in (0, 1):
            counts[label] += np.bincount(buckets[labels[rows] == label], minlength=1 << _BITS)
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.record_batch(
        {"bucket": pa.array(at), "n0": pa.array(counts[0, at]), "n1": pa.array(counts[1, at])}
    )


def _examples(wanted: np.ndarray):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch, texts in blocks(batches, size=_TEXT_BLOCK):
            rows, buckets = _held(texts, wanted)
            ends = np.searchsorted(rows, np.arange(len(texts) + 1))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "label": batch.column("label"),
                    "buckets": pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(buckets.astype(np.int32))
                    ),
                }
            )

    return collect


def _fit(features: np.ndarray, ends: np.ndarray, ratios: np.ndarray, labels: np.ndarray):
    """Logistic regression on the scaled features by full gradient steps, from naive Bayes on.

    Coefficients begin at a tenth of naive Bayes, whose are 1, and the penalty is on how far they go from there.
    """
    rows = np.repeat(np.arange(len(labels)), np.diff(ends))
    values = ratios[features]
    used, place = np.unique(features, return_inverse=True)
    coefficients, bias = np.full(len(used), 0.1), 0.0
    moment1, moment2 = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    for step in range(1, 201):
        total = np.bincount(rows, values * coefficients[place], minlength=len(labels)) + bias
        error = share * (1 / (1 + np.exp(-np.clip(total, -500, 500))) - labels)
        slope = np.bincount(place, values * error[rows], minlength=len(used))
        slope += 1e-5 * (coefficients - 0.1)
        slope = np.append(slope, error.sum())
        moment1 = 0.9 * moment1 + 0.1 * slope
        moment2 = 0.99 * moment2 + 0.01 * slope**2
        move = 0.03 * (moment1 / (1 - 0.9**step)) / (np.sqrt(moment2 / (1 - 0.99**step)) + 1e-9)
        coefficients -= move[:-1]
        bias -= move[-1]
    weights = np.zeros(1 << _BITS)
    weights[used] = ratios[used] * coefficients
    return Model(weights, float(bias))


def train(
    docs: DataFrame,
    labels: DataFrame,
    most: tuple[int, int] = (4000, 2000),
    least_ratio: float = 1.0,
    least_texts: int = 3,
    least_z: float = 4.0,
) -> Model:
    """Fit on at most `most` texts of labels 0 and 1, drawn by a hash of the doc_id.

    `labels` (doc_id, toxic) are the rows to learn from; toxic is 1 or 0, other values and
    rows whose text is missing are left out. The draw is broadcast: at most sum(most) ids.
    N-grams get no weight if fewer than `least_texts` of the drawn texts hold them, if their log
    ratio is nearer to 0 than `least_ratio`, or if the number of texts of label 1 that
    hold them is within `least_z` standard deviations of what chance would give. With texts of one
    label only, or of none, every text scores the smoothed share of label 1.
    """
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label")
    ).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    drawn = None
    for label in (0, 1):
        some = (
            known.filter(F.col("label") == label)
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(most[label])
        )
        drawn = some if drawn is None else drawn.union(some)
    texts = saved(
        documents(docs)
        .filter("text IS NOT NULL")
        .join(F.broadcast(drawn), "doc_id")
        .select("doc_id", "text", "label"),
        "labelled",
    )
    sizes = {row.label: row.n for row in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        share = (n1 + 1) / (n0 + n1 + 2)
        return Model(np.zeros(1 << _BITS), float(np.log(share / (1 - share))))
    counted = (
        texts.mapInArrow(_counts, "bucket long, n0 long, n1 long")
        .groupBy("bucket")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .toArrow()
    )
    at, c0, c1 = (counted[name].to_numpy() for name in ("bucket", "n0", "n1"))
    ratio = np.log((c1 + 1) / (n1 + 2)) - np.log((c0 + 1) / (n0 + 2))
    by_chance = (c0 + c1) * n1 / (n0 + n1)
    z = (c1 - by_chance) / np.sqrt(by_chance * n0 / (n0 + n1))
    telling = (np.abs(ratio) >= least_ratio) & (c0 + c1 >= least_texts) & (np.abs(z) >= least_z)
    ratios = np.zeros(1 << _BITS)
    ratios[at[telling]] = ratio[telling]
    examples = (
        texts.mapInArrow(_examples(ratios != 0), "doc_id long, label int, buckets array<int>")
        .orderBy("doc_id")
        .toArrow()
        .combine_chunks()
    )
    lists = examples["buckets"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ends = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    return _fit(lists.flatten().to_numpy(), ends, ratios, examples["label"].to_numpy())


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, score) of every row of `docs`, by its whole text; NULL counts as empty.

    `score`, from 0 to 1, is the probability of label 1. An empty text has no n-grams and
    scores by the bias alone. Rows without doc_id and repeated rows are scored like others.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch, texts in blocks(batches, size=_TEXT_BLOCK):
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "score": pa.array(model.scores(texts))}
            )

    return documents(docs, id_col).mapInArrow(score, "doc_id long, score double")


def with_toxicity(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """All columns of `docs`, which has a column text, and the score as another."""

    named = plainly_named(docs)
    text = named.columns[docs.columns.index("text")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch, texts in blocks(batches, text, _TEXT_BLOCK):
            yield batch.append_column("score", pa.array(model.scores(texts)))

    scored = StructType([*named.schema, StructField("score", DoubleType())])
    return named.mapInArrow(score, scored).toDF(*docs.columns, column)
