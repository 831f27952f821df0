"""Benchmark decontamination: documents that hold a passage of a benchmark, exact or nearly.

Every window of a document that is as long as some item (lengths within a ninth share one
size), at every word, gets a 64-bit SimHash of its words. A window is a candidate for an item of its length if the fingerprints
differ in at most `radius` bits. To find all such pairs, fingerprints are cut into four
16-bit blocks: of `radius` differing bits at most a quarter, rounded down, can fall in every block, so
one block at least is that near. For each block a table of all 65,536 values says whether
it is that near to some item's, which settles nearly all windows by four lookups. Candidates'
words are then compared with the item's: similarity of the weighted shingles, exact.

Fingerprints find copies; of windows altered up to the limit of similarity most are beyond any
radius that tells windows apart. Those are found by anchors: so many of an item's shingles, rare ones
first, that a window without any of them cannot be similar enough. A document that holds an anchor is compared with the
item at every word, by counts that move along with the window, so none is lost.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import blocks, documents, let_go, row_key
from starflow.llm.words import Words

_BLOCKS = 4
_CHUNK = 4096  # words whose bit counts are held at once


def _bits(hashes: np.ndarray, widest: int) -> np.ndarray:
    """The 64 bits of each word's hash, as counters wide enough for `widest` words."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits if widest < 256 else bits.astype(np.uint16 if widest < 1 << 16 else np.uint32)


def _sums(ones: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, sums of every `size` consecutive rows), for ascending sizes. A sum is put together
    from the size before and sums of powers of two."""
    powers = [ones]
    total, done = None, 0
    for size in sizes:
        if size > len(ones):
            return
        rest, bit = size - done, 0
        while rest:
            while len(powers) <= bit:
                half, width = powers[-1], 1 << (len(powers) - 1)
                powers.append(half[:-width] + half[width:])
            if rest & 1:
                n = len(ones) - (done + (1 << bit)) + 1
                total = powers[bit][:n] if total is None else total[:n] + powers[bit][done : done + n]
                done += 1 << bit
            rest >>= 1
            bit += 1
        yield size, total


def _majority(sums: np.ndarray, size: int) -> np.ndarray:
    """SimHashes: a bit is 1 where more than half of the words' are."""
    above = sums > sums.dtype.type(size // 2)
    return np.packbits(above.reshape(-1), bitorder="little").view(np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """SimHash of some words."""
    size = len(hashes)
    return int(_majority(_bits(hashes, size).sum(axis=0, dtype=np.uint32), size)[0])


def weighted_shingles(words: np.ndarray, k: int) -> Counter:
    """Shingles of k words and how often each occurs; of fewer words, all as one."""
    values = words.tolist()
    if len(values) < k:
        return Counter([tuple(values)])
    return Counter(zip(*(values[j:] for j in range(k))))


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: smaller weights over larger weights."""
    shared = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared)


class Items:
    """Benchmark items by the size of their window, ready for lookups.

    Window sizes are lengths of items. An item whose length is not one of them is looked up by
    its first words, a ninth fewer at most, and then compared in its own length.
    """

    def __init__(
        self, ids: list[int], texts: list[str], radius: int, shingle: int, percent: int
    ) -> None:
        words = Words(pa.array(texts, pa.large_string()), lower=True, marks=False)
        hashes = words.hashes()
        self.radius, self.shingle = radius, shingle
        members = defaultdict(list)
        size = 0
        for i in np.argsort(words.count, kind="stable").tolist():
            count = int(words.count[i])
            if count:
                if not size or 8 * count > 9 * size:
                    size = count
                members[size].append(i)
        near = np.array(
            [0]
            + [
                sum(1 << b for b in bits)
                for n in range(1, radius // _BLOCKS + 1)
                for bits in combinations(range(16), n)
            ]
        )
        self.sizes: dict[int, tuple] = {}
        for size, held in members.items():
            own = [hashes[words.first[i] : words.first[i + 1]] for i in held]
            prints = np.array([simhash(x[:size]) for x in own], np.uint64)
            tables = np.zeros((_BLOCKS, 1 << 16), bool)
            for block in range(_BLOCKS):
                part = (prints >> np.uint64(16 * block)).astype(np.int64) & 0xFFFF
                tables[block, (part[:, None] ^ near).reshape(-1)] = True
            items = [(ids[i], len(x), weighted_shingles(x, shingle)) for i, x in zip(held, own)]
            self.sizes[size] = (prints, tables, items)
        self._anchor(ids, words, hashes, percent)

    def _anchor(self, ids: list[int], words: Words, hashes: np.ndarray, percent: int) -> None:
        """Anchors of every item that has a shingle. Shorter ones are found as exact copies only."""
        values, at = words.runs(hashes, self.shingle)
        first = np.searchsorted(at, words.first)
        distinct, held = np.unique(values, return_counts=True)
        self.whole: list[tuple] = []  # id, number of shingles, distinct ones, weight of each
        anchors: list[np.ndarray] = []
        for i, item_id in enumerate(ids):
            own, weights = np.unique(values[first[i] : first[i + 1]], return_counts=True)
            if not len(own):
                continue
            n = int(weights.sum())
            order = np.argsort(held[np.searchsorted(distinct, own)], kind="stable")
            # What is left without the anchors is less than the share two similar windows have.
            left = n - np.cumsum(weights[order])
            few = int(np.flatnonzero(100 * left < percent * n - 1e-7)[0]) + 1
            anchors.append(own[order[:few]])
            self.whole.append((item_id, n, own, weights))
        every = np.concatenate(anchors) if anchors else np.empty(0, np.uint64)
        holder = np.repeat(np.arange(len(anchors)), [len(x) for x in anchors])
        order = np.argsort(every, kind="stable")
        self.holder = holder[order]
        self.anchors, begin = np.unique(every[order], return_index=True)
        self.begin = np.append(begin, len(every))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.anchors & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def candidates(self, prints: np.ndarray, size: int) -> Iterator[tuple[int, tuple]]:
        """(window, item) of this size whose fingerprints are within the radius."""
        own, tables, items = self.sizes[size]
        parts = prints.view(np.uint16).reshape(-1, _BLOCKS)
        near = tables[0].take(parts[:, 0])
        for block in range(1, _BLOCKS):
            near |= tables[block].take(parts[:, block])
        near = np.flatnonzero(near)
        for begin in range(0, len(own), 256):
            apart = np.bitwise_count(prints[near][:, None] ^ own[begin : begin + 256])
            for hit in np.flatnonzero(apart.reshape(-1) <= self.radius).tolist():
                at, i = divmod(hit, apart.shape[1])
                yield int(near[at]), items[begin + i]

    def anchored(self, values: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, tuple]]:
        """(row, item) where a row has an anchor of the item among its shingles."""
        near = np.flatnonzero(self.maybe.take((values & np.uint64((1 << 20) - 1)).astype(np.int64)))
        if not len(near):
            return
        place = np.minimum(np.searchsorted(self.anchors, values[near]), len(self.anchors) - 1)
        same = self.anchors[place] == values[near]
        pairs = set()
        for at in np.unique(rows[near[same]] * len(self.anchors) + place[same]).tolist():
            row, anchor = divmod(at, len(self.anchors))
            pairs.update((row, i) for i in self.holder[self.begin[anchor] : self.begin[anchor + 1]].tolist())
        for row, i in sorted(pairs):
            yield row, self.whole[i]


def _best_window(values: np.ndarray, item: tuple, percent: int) -> tuple[float, int, int] | None:
    """Best similarity of an item and a window of a text's shingles, the window's first
    shingle and how many it has: as many as the item, or all up to the end of the text."""
    _, n, own, weights = item
    place = np.minimum(np.searchsorted(own, values), len(own) - 1)
    inside = own[place] == values
    sums = np.concatenate(([0], np.cumsum(inside)))
    start = np.arange(len(values))
    end = np.minimum(start + n, len(values))
    most = sums[end] - sums[start]
    which = np.where(inside, place, -1)
    have, shared, low, high, best = [0] * len(own), 0, 0, 0, None
    weights = weights.tolist()
    for at in np.flatnonzero((100 + percent) * most >= percent * (n + end - start) - 1e-6).tolist():
        if at >= high:
            have, shared, low, high = [0] * len(own), 0, at, at
        for x in which[low:at].tolist():
            if x >= 0:
                have[x] -= 1
                shared -= have[x] < weights[x]
        for x in which[high : end[at]].tolist():
            if x >= 0:
                shared += have[x] < weights[x]
                have[x] += 1
        low, high = at, int(end[at])
        likeness = shared / (n + high - low - shared)
        if 100 * likeness >= percent - 1e-9 and (best is None or likeness > best[0]):
            best = (likeness, at, high - low)
    return best


def _matches(words: Words, items: Items, percent: int) -> dict[tuple[int, int], tuple[float, int, int]]:
    """Best similarity, first word and length of each (row, item) that is similar enough."""
    hashes = words.hashes()
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    sizes = sorted(items.sizes)
    widest = sizes[-1] if sizes else 0
    step = max(_CHUNK, 4 * widest)
    for begin in range(0, len(hashes), step):
        ones = _bits(hashes[begin : begin + step + widest], widest)
        for size, sums in _sums(ones, sizes):
            prints = _majority(sums, size)[:step]
            for found, (item_id, length, shingles) in items.candidates(prints, size):
                start = found + begin
                row = int(words.row[start])
                if start + length > words.first[row + 1]:
                    continue
                key = (row, item_id)
                if best.get(key, (0.0,))[0] == 1.0:
                    continue
                own = weighted_shingles(hashes[start : start + length], items.shingle)
                likeness = weighted_similarity(own, shingles)
                if 100 * likeness >= percent - 1e-9 and likeness > best.get(key, (0.0,))[0]:
                    best[key] = (likeness, start - int(words.first[row]), length)
    values, at = words.runs(hashes, items.shingle)
    first = np.searchsorted(at, words.first)
    for row, item in items.anchored(values, words.row[at]):
        key = (row, item[0])
        if best.get(key, (0.0,))[0] == 1.0:
            continue
        found = _best_window(values[first[row] : first[row + 1]], item, percent)
        if found and found[0] >= best.get(key, (0.0,))[0]:
            likeness, start, n = found
            best[key] = (likeness, start, n + items.shingle - 1)
    return best


def _search(items: Items, percent: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch, texts in blocks(batches):
            found = _matches(Words(texts, lower=True, marks=False), items, percent)
            if not found:
                continue
            keys = sorted(found)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").take(pa.array([row for row, _ in keys])),
                    "row": batch.column("row").take(pa.array([row for row, _ in keys])),
                    "item_id": pa.array([item for _, item in keys], pa.int64()),
                    "similarity": pa.array([found[k][0] for k in keys]),
                    "start_word": pa.array([found[k][1] for k in keys], pa.int32()),
                    "n_words": pa.array([found[k][2] for k in keys], pa.int32()),
                }
            )

    return search


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    radius: int = 7,
    shingle: int = 5,
    percent: int = 80,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """(doc_id, row, item_id, similarity, start_word, n_words): the best window of each document
    that holds an item of `benchmark` (item_id, text).

    Words are runs of letters and digits, and of any characters beyond ASCII; case of A-Z doesn't
    count. A window has as many words as the item, or fewer where the document ends. It matches if
    the weighted Jaccard similarity of their `shingle`-word shingles is `percent` % or more; of
    equals the first window stands. Every window is found, whatever the `radius` within which
    SimHashes are compared: that only decides which are found by fingerprint and which by anchor.

    The benchmark is the query set. It goes to the tasks in blocks of at most `block_bytes` of
    text, each of which is compared with all documents by one pass without a shuffle; an
    item by itself makes at least one block. Rows with no words, or no id, match nothing. Documents without id
    are searched too and give a NULL doc_id; `row` is a hash of the text. Rows that repeat a doc_id or an item_id are each searched.
    """
    spark = docs.sparkSession
    queries = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("item_id IS NOT NULL AND text IS NOT NULL")
    searched = documents(docs).withColumn("row", row_key())
    schema = "doc_id long, row long, item_id long, similarity double, start_word int, n_words int"
    passes, ids, texts, held = [], [], [], 0

    def add() -> None:
        items = Items(ids, texts, radius, shingle, percent)
        passes.append(searched.mapInArrow(_search(items, percent), schema))

    for item in queries.orderBy("item_id", "text").toLocalIterator():
        if held and held + len(item.text) > block_bytes:
            add()
            ids, texts, held = [], [], 0
        ids.append(item.item_id)
        texts.append(item.text)
        held += len(item.text)
    if held:
        add()
    if not passes:
        return spark.createDataFrame([], schema)
    found = passes[0]
    for one in passes[1:]:
        found = found.union(one)
    return found
