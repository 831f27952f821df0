"""Language ID: a convolutional network over bytes, written and trained in numpy.

A window of 256 bytes is embedded byte by byte; filters 2, 3 and 4 bytes wide slide over
it, the maximum of each filter over the window is its feature, and a softmax over the features
gives a probability for each language. A text is cut into windows that overlap by the widest
filter less one, so no n-gram is lost; its probabilities are the means over its windows,
weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import blocks, documents

WINDOW = 256
WIDTHS = (2, 3, 4)
STRIDE = WINDOW - max(WIDTHS) + 1
UNKNOWN = "und"


def windows(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, zero-padded; the text each is of; its bytes that are text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = texts.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
    length = np.diff(offsets)
    count = np.where(length > 0, 1 + np.maximum(0, -(-(length - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(texts)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = nth * STRIDE
    size = np.minimum(WINDOW, length[row] - begin)
    at = (offsets[row] + begin)[:, None] + np.arange(WINDOW)
    taken = held[np.minimum(at, len(held) - 1)]
    taken[np.arange(WINDOW) >= size[:, None]] = 0
    return taken, row, size


class ByteCnn:
    """The network's parameters, forward pass and training."""

    def __init__(self, names: list[str], embed: int = 8, filters: int = 12, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)
        self.names = names
        self.embed = draw.normal(0, 0.5, (256, embed)).astype(np.float32)
        # Filters of all widths side by side; what a narrow one doesn't reach stays 0.
        widest, total = max(WIDTHS), filters * len(WIDTHS)
        self.reach = np.zeros((widest, embed, total), np.float32)
        for i, width in enumerate(WIDTHS):
            self.reach[:width, :, i * filters : (i + 1) * filters] = 1
        self.reach = self.reach.reshape(widest * embed, total)
        scale = 1 / np.sqrt(self.reach.sum(axis=0))
        self.kernel = (draw.normal(0, 1, self.reach.shape) * scale).astype(np.float32) * self.reach
        self.shift = np.zeros(total, np.float32)
        self.out = draw.normal(0, 0.1, (total, len(names))).astype(np.float32)
        self.bias = np.zeros(len(names), np.float32)

    def _patches(self, taken: np.ndarray) -> np.ndarray:
        """For each place of a filter the embedded bytes it sees: (windows, places, widest * embed)."""
        n, size = taken.shape
        embed = self.embed.shape[1]
        seen = max(WIDTHS) * embed
        embedded = self.embed.take(taken, axis=0).reshape(n, size * embed)
        step = embedded.strides[1]
        return np.lib.stride_tricks.as_strided(
            embedded,
            (n, size - max(WIDTHS) + 1, seen),
            (embedded.strides[0], embed * step, step),
            writeable=False,
        )

    def _pooled(self, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        patches = self._patches(taken)
        n, places, seen = patches.shape
        return patches, (patches.reshape(n * places, seen) @ self.kernel).reshape(n, places, -1)

    @staticmethod
    def _softmax(logits: np.ndarray) -> np.ndarray:
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        return logits / logits.sum(axis=1, keepdims=True)

    def probabilities(self, taken: np.ndarray, batch: int = 64) -> np.ndarray:
        """Of each language, for each window. Small batches stay in a core's cache."""
        found = np.empty((len(taken), len(self.names)), np.float32)
        for begin in range(0, len(taken), batch):
            _, response = self._pooled(taken[begin : begin + batch])
            features = np.maximum(response.max(axis=1) + self.shift, 0)
            found[begin : begin + batch] = self._softmax(features @ self.out + self.bias)
        return found

    def train(self, taken: np.ndarray, labels: np.ndarray, epochs: int = 6, rate: float = 0.01) -> None:
        """Adam on cross-entropy; each epoch in another fixed order."""
        draw = np.random.default_rng(11)
        parts = ("embed", "kernel", "shift", "out", "bias")
        moments = {p: (np.zeros_like(getattr(self, p)), np.zeros_like(getattr(self, p))) for p in parts}
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(taken))
            for begin in range(0, len(order), 64):
                some = order[begin : begin + 64]
                step += 1
                slopes = self._slopes(taken[some], labels[some])
                for part, slope in slopes.items():
                    m, v = moments[part]
                    m += 0.1 * (slope - m)
                    v += 0.001 * (slope**2 - v)
                    move = (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                    getattr(self, part)[...] -= rate * move

    def _slopes(self, taken: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        patches, response = self._pooled(taken)
        n, _, total = response.shape
        place = response.argmax(axis=1)
        top = np.take_along_axis(response, place[:, None, :], 1)[:, 0] + self.shift
        features = np.maximum(top, 0)
        error = self._softmax(features @ self.out + self.bias)
        error[np.arange(n), labels] -= 1
        error /= n
        back = (error @ self.out.T) * (top > 0)
        seen = patches[np.arange(n)[:, None], place]  # (windows, filters, widest * embed)
        kernel = np.einsum("nfs,nf->sf", seen, back) * self.reach
        into = (back[:, :, None] * self.kernel.T).reshape(n * total, max(WIDTHS), -1)
        embed = np.zeros_like(self.embed)
        bytes_at = place[:, :, None] + np.arange(max(WIDTHS))
        codes = taken[np.arange(n)[:, None, None], bytes_at].reshape(n * total, -1)
        np.add.at(embed, codes, into)
        return {
            "embed": embed,
            "kernel": kernel,
            "shift": back.sum(axis=0),
            "out": features.T @ error,
            "bias": error.sum(axis=0),
        }


def _some_windows(most: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            taken, row, _ = windows(texts)
            count = np.bincount(row, minlength=len(texts))
            first = np.cumsum(count) - count
            rows = np.flatnonzero(count)
            # Evenly over the text, from beginning to end.
            at = first[rows][:, None] + (np.arange(most) * count[rows][:, None]) // most
            chosen = np.unique(at)
            of = row[chosen]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(of)),
                    "nth": pa.array((chosen - first[of]).astype(np.int64)),
                    "lang": batch.column("lang").take(pa.array(of)),
                    "bytes": pa.array([x.tobytes() for x in taken[chosen]], pa.binary()),
                }
            )

    return cut


def train(
    labelled: DataFrame, per_language: int = 500, per_text: int = 4, max_languages: int = 1000
) -> ByteCnn | None:
    """Fit on `labelled` (doc_id, text, lang); None if no row has both text and language.

    At most `per_language` texts of each language are drawn, by a hash of their doc_id, and at
    most `per_text` windows of each, evenly spaced. Only ids are ranked, and those drawn are
    broadcast. More than `max_languages` languages are an error.
    """
    known = labelled.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    names = [r.lang for r in known.select("lang").distinct().orderBy("lang").limit(max_languages + 1).collect()]
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not names:
        return None
    drawn = known.selectExpr("doc_id", "lang", "xxhash64(doc_id) AS draw").selectExpr(
        "doc_id", "lang", "row_number() OVER (PARTITION BY lang ORDER BY draw, doc_id) AS nth"
    )
    drawn = drawn.filter(F.col("nth") <= per_language).select("doc_id", "lang").distinct()
    cut = (
        known.join(F.broadcast(drawn), ["doc_id", "lang"])
        .mapInArrow(_some_windows(per_text), "doc_id long, nth long, lang string, bytes binary")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("nth", "ascending"), ("bytes", "ascending")])
    )
    place = {name: i for i, name in enumerate(names)}
    labels = np.array([place[x] for x in cut["lang"].to_pylist()])
    taken = np.frombuffer(b"".join(cut["bytes"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    model = ByteCnn(names)
    model.train(taken, labels)
    return model


def _predict(model: ByteCnn | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if model is not None:
                taken, row, size = windows(texts)
                summed = np.zeros((len(texts), len(model.names)))
                np.add.at(summed, row, model.probabilities(taken) * size[:, None])
                total = np.maximum(np.bincount(row, size, minlength=len(texts)), 1)
                lettered = batch.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
                best = summed.argmax(axis=1)
                names = np.where(lettered, np.array(model.names, object)[best], UNKNOWN)
                scores = np.where(lettered, summed.max(axis=1) / total, 0.0)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": pa.array(names.tolist(), pa.string()),
                    "score": pa.array(np.clip(scores, 0, 1).astype(np.float64)),
                }
            )

    return predict


def identify(docs: DataFrame, model: ByteCnn | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of `docs` (doc_id, text), by its whole text.

    A text that is NULL or has no letter, or any text where there is no model, is `und` with
    score 0. Rows without doc_id and repeated rows are judged like others.
    """
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return (
        documents(docs)
        .withColumn("lettered", lettered)
        .mapInArrow(_predict(model), "doc_id long, lang_pred string, score double")
    )
