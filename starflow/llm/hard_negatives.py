"""Hard-negative mining over a multiway tree of hyperplanes with distance ranges.

Each node of the tree has several split points, and a row belongs to the nearest. For each split point
and each sibling subtree the node keeps the range of distances from the point to the subtree's
rows, all rows counted. A search for scores within a window is one for distances within an annulus: a
subtree is left out where, for some split point, no distance in its range can lie in the annulus.
What is left is compared exactly.

Scores are inner products, which distances follow once every row x gets one more component,
the root of M - |x|² with M the largest |x|²: then |q - x|² = |q|² + M - 2 q·x for a query q
with 0 there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starflow.llm.rows import saved

# Rows the tree is grown from, and whose scores first bound a search. All rows are indexed.
SAMPLE = 4096
FAN_OUT, DEPTH, LEAST = 8, 2, 32
# Rows compared at a time; a leaf with more is dealt out over several tasks.
BLOCK_ROWS = 1 << 17
_SLICE, _ASKED = 1 << 13, 256
# Squared lengths from here on would give scores that are no longs; sums beyond the other are not exact in doubles.
_TOO_LONG, _EXACT = float(1 << 62), float(1 << 52)


# ---------------------------------------------------------------------------
# Rows to whole numbers.


def _matrix(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of the batch's vectors, shorter ones filled with 0; and which rows take part."""
    lists = batch.column("vector")
    lengths = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
    wide = int(lengths.max(initial=0))
    held = np.maximum(lengths, 0)
    row = np.repeat(np.arange(len(held)), held)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(held) - held, held)
    made = np.zeros((len(lengths), wide))
    with np.errstate(over="ignore", invalid="ignore"):
        made[row, place] = np.floor(scale * flat)
        square = np.einsum("ij,ij->i", made, made)
    fine = np.isfinite(made).all(axis=1) & (square < _TOO_LONG) & (lengths >= 0)
    fine &= ~np.array(batch.column("vec_id").is_null()) & ~np.array(batch.column("label").is_null())
    return made, fine


def _prepared(scale: float):
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, fine = _matrix(batch, scale)
            part = batch.filter(pa.array(fine))
            whole = made[fine].astype("<i8")
            yield pa.record_batch(
                {
                    "vec_id": part.column("vec_id"),
                    "label": part.column("label"),
                    "anchor": part.column("anchor"),
                    "vec": pa.array([v.tobytes() for v in whole], pa.binary()),
                    "square": pa.array((whole * whole).sum(axis=1), pa.int64()),
                    "most": pa.array(np.abs(whole).max(axis=1, initial=0), pa.int64()),
                }
            )

    return prepare


def _unpacked(column: pa.Array, kind: str, wide: int) -> np.ndarray:
    """Binary vectors as a matrix of doubles, filled with 0 up to `wide`."""
    size = np.dtype(kind).itemsize
    parts = column.to_pylist()
    if all(len(p) == wide * size for p in parts):
        return np.frombuffer(b"".join(parts), kind).reshape(len(parts), wide).astype(np.float64)
    return np.frombuffer(b"".join(p.ljust(wide * size, b"\0") for p in parts), kind).reshape(len(parts), wide).astype(np.float64)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, exact, as 64-bit whole numbers."""
    longest = [np.einsum("ij,ij->i", x, x).max(initial=0) for x in (a, b)]
    if max(longest) < _EXACT:  # so is every partial sum
        return (a @ b.T).astype(np.int64)
    return (a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T).astype(np.int64)


# ---------------------------------------------------------------------------
# The tree.


@dataclass
class Tree:
    """Split points by node. A child is a node, or -1 - leaf. `low` and `high` are the distance ranges by
    split point and child."""

    most: float  # M
    wide: int
    points: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0
    low: list[np.ndarray] = field(default_factory=list)
    high: list[np.ndarray] = field(default_factory=list)

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        """Rows with the component that makes all equally long."""
        rest = np.maximum(self.most - np.einsum("ij,ij->i", rows, rows), 0)
        return np.concatenate([rows, np.sqrt(rest)[:, None]], axis=1)

    def grow(self, rows: np.ndarray, depth: int, fan_out: int, least: int) -> int:
        """A node, or a leaf, for lifted rows; split points are far from each other, the first row among them."""
        chosen = [0] if len(rows) else []
        nearest = self._far(rows, rows[:1]).ravel() if len(rows) else rows
        while depth and len(rows) > least and len(chosen) < fan_out and nearest.max() > self.slack:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, self._far(rows, rows[chosen[-1:]]).ravel())
        if len(chosen) < 2:
            self.leaves += 1
            return -self.leaves
        node = len(self.points)
        self.points.append(rows[chosen])
        self.children.append([])
        own = self._far(rows, rows[chosen]).argmin(axis=1)
        self.children[node] = [
            self.grow(rows[own == child], depth - 1, fan_out, least) for child in range(len(chosen))
        ]
        return node

    @property
    def slack(self) -> float:
        """More than rounding can move a distance."""
        return 1e-5 * np.sqrt(self.most)

    def _far(self, rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of lifted rows."""
        return np.sqrt(np.maximum(2 * self.most - 2 * (rows @ points.T), 0))

    def walk(self, rows: np.ndarray, see=None) -> np.ndarray:
        """The leaf of each lifted row. `see(node, child, distances)` is shown what comes by."""
        leaf = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))] if self.points else []
        while todo:
            node, at = todo.pop()
            far = self._far(rows[at], self.points[node])
            own = far.argmin(axis=1)
            for child, below in enumerate(self.children[node]):
                here = own == child
                if here.any():
                    if see is not None:
                        see(node, child, far[here])
                    if below < 0:
                        leaf[at[here]] = -1 - below
                    else:
                        todo.append((below, at[here]))
        return leaf

    def reached(self, queries: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """Which leaves may hold a row whose score lies in one of a query's windows [low, high], by
        query and leaf. Windows without a score have low > high."""
        found = np.zeros((len(queries), self.leaves), bool)
        square = np.einsum("ij,ij->i", queries, queries)[:, None] + self.most
        asked = lows <= highs
        outer = np.sqrt(np.maximum(square - 2.0 * lows, 0)) + self.slack
        inner = np.sqrt(np.maximum(square - 2.0 * highs, 0)) - self.slack
        if not self.points:
            found[:] = asked.any(axis=1)[:, None]
            return found
        todo = [(0, np.flatnonzero(asked.any(axis=1)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            far = np.sqrt(np.maximum(square[at] - 2 * (queries[at] @ self.points[node][:, :-1].T), 0))
            far = far[:, :, None]
            low, high = self.low[node][None], self.high[node][None]
            nearest = np.maximum(far - high, low - far).max(axis=1)  # by child
            farthest = (far + high).min(axis=1)
            meets = asked[at, None, :] & (nearest[:, :, None] <= outer[at, None, :]) & (farthest[:, :, None] >= inner[at, None, :])
            keep = meets.any(axis=2)
            for child, below in enumerate(self.children[node]):
                if below < 0:
                    found[at[keep[:, child]], -1 - below] = True
                else:
                    todo.append((below, at[keep[:, child]]))
        return found


def _placed(tree: Tree, kind: str):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _unpacked(batch.column("vec"), "<i8", tree.wide)
            small = rows.astype(kind)
            yield pa.record_batch(
                {
                    **{n: batch.column(n) for n in ("vec_id", "label", "anchor")},
                    "vec": pa.array([v.tobytes() for v in small], pa.binary()),
                    "leaf": pa.array(tree.walk(tree.lifted(rows)), pa.int32()),
                }
            )

    return place


def _ranges(tree: Tree, kind: str):
    """Distance ranges of a task's rows, by node, split point and child."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
        high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]

        def see(node: int, child: int, far: np.ndarray) -> None:
            low[node][:, child] = np.minimum(low[node][:, child], far.min(axis=0))
            high[node][:, child] = np.maximum(high[node][:, child], far.max(axis=0))

        for batch in batches:
            tree.walk(tree.lifted(_unpacked(batch.column("vec"), kind, tree.wide)), see)
        rows = [
            (node, i, j, low[node][i, j], high[node][i, j])
            for node in range(len(low))
            for i, j in zip(*np.nonzero(np.isfinite(low[node])))
        ]
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
        yield pa.record_batch(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["node", "point", "child", "low", "high"]
        )

    return measure


@dataclass
class Index:
    """All rows by leaf, the tree, and the sample that bounds searches."""

    rows: DataFrame  # vec_id, label, anchor, vec, leaf, key
    tree: Tree
    kind: str
    first_key: np.ndarray  # of each leaf; the last is the number of keys
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, labels, vectors


def build_index(
    rows: DataFrame, is_anchor: Column, scale: float, sample: int = SAMPLE, fan_out: int = FAN_OUT, depth: int = DEPTH
) -> Index | None:
    """The index of `rows` (vec_id, label, embedding); None if no row takes part.

    The tree grows from the `sample` rows with the least hashes of vec_id; ranges and leaves are those of all rows. What
    comes to the driver and goes to the tasks: the sample, at most fan_out**depth leaves' counts and
    fan_out**(depth + 1) ranges.
    """
    given = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    prepared = given.mapInArrow(
        _prepared(scale), "vec_id long, label long, anchor boolean, vec binary, square long, most long"
    )
    facts = prepared.agg(F.max("square").alias("square"), F.max(F.length("vec")).alias("size"), F.max("most").alias("most")).first()
    if facts["square"] is None:
        return None
    wide = facts["size"] // 8
    kind = next(k for k in ("<i2", "<i4", "<i8") if facts["most"] <= np.iinfo(k).max)
    drawn = prepared.select("vec_id", "label", "vec").orderBy(F.xxhash64("vec_id"), "vec_id", "label", "vec").limit(sample).toArrow()
    vectors = _unpacked(drawn.column("vec").combine_chunks(), "<i8", wide)
    tree = Tree(float(max(facts["square"], 1)), wide)
    tree.grow(tree.lifted(vectors), depth, fan_out, LEAST)
    placed = saved(
        prepared.mapInArrow(_placed(tree, kind), "vec_id long, label long, anchor boolean, vec binary, leaf int"), "placed"
    )
    ranges = (
        placed.select("vec")
        .mapInArrow(_ranges(tree, kind), "node int, point int, child int, low double, high double")
        .groupBy("node", "point", "child")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    for r in ranges.collect():
        tree.low[r.node][r.point, r.child], tree.high[r.node][r.point, r.child] = r.low, r.high
    counts = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():
        counts[r.leaf] = r["count"]
    first_key = np.concatenate(([0], np.cumsum(np.maximum(1, -(-counts // BLOCK_ROWS)))))
    # Rows of a large leaf are dealt out in turn, equal ones too.
    firsts = F.array(*[F.lit(int(k)) for k in first_key])
    first, after = F.get(firsts, F.col("leaf")), F.get(firsts, F.col("leaf") + 1)
    keyed = placed.withColumn("key", (first + F.pmod(F.monotonically_increasing_id(), after - first)).cast("int"))
    ids, labels = (drawn.column(n).to_numpy() for n in ("vec_id", "label"))
    return Index(keyed, tree, kind, first_key, (ids, labels, vectors))


# ---------------------------------------------------------------------------
# Searches.


def _best(scores: np.ndarray, ids: np.ndarray, may: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` highest scores among those that may; ties by smaller id."""
    at = np.flatnonzero(may)
    if len(at) > 4 * most:
        least = np.partition(scores[at], len(at) - most)[len(at) - most]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))[:most]]


def _fitting(scores, ids, labels, asker, label, low, high, same: bool) -> np.ndarray:
    """Which rows are of the wanted kind with a score in the window; a row is not its own positive."""
    kind = (labels == label) & (ids != asker) if same else labels != label
    return kind & (scores >= low) & (scores <= high)


_ASK = "key int, kind int, vec_id long, label long, vec binary, lows array<long>, highs array<long>"


def _asked(index_parts, same: bool, most: int):
    """Each anchor, once for every block of rows that may hold something for it."""
    tree, kind, first_key, (ids, labels, vectors) = index_parts

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, _ASKED):
                batch = whole.slice(begin, _ASKED)
                queries = _unpacked(batch.column("vec"), kind, tree.wide)
                own_id, own_label = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
                windows = list(zip(batch.column("lows").to_pylist(), batch.column("highs").to_pylist()))
                wide = max(len(lows) for lows, _ in windows)
                lows, highs = np.full((len(queries), wide), 1), np.full((len(queries), wide), 0)
                scores = _products(queries, vectors)
                for row, (low_row, high_row) in enumerate(windows):
                    for w, (low, high) in enumerate(zip(low_row, high_row)):
                        fits = _fitting(scores[row], ids, labels, own_id[row], own_label[row], low, high, same)
                        if np.count_nonzero(fits) >= most:  # no row below what the sample alone gives
                            low = int(np.partition(scores[row][fits], -most)[-most])
                        lows[row, w], highs[row, w] = low, high
                leaves = tree.reached(queries, lows, highs)
                for leaf in range(tree.leaves):
                    rows = np.flatnonzero(leaves[:, leaf])
                    if len(rows):
                        part = batch.take(pa.array(rows))
                        bounds = [pa.array(x[rows].tolist(), pa.list_(pa.int64())) for x in (lows, highs)]
                        for key in range(first_key[leaf], first_key[leaf + 1]):
                            yield pa.record_batch(
                                [
                                    pa.array([key] * len(rows), pa.int32()),
                                    pa.array([1] * len(rows), pa.int32()),
                                    *[part.column(n) for n in ("vec_id", "label", "vec")],
                                    *bounds,
                                ],
                                ["key", "kind", "vec_id", "label", "vec", "lows", "highs"],
                            )

    return ask


def _answered(kind: str, wide: int, same: bool, most: int):
    """Rows of a block, then the anchors that ask for it: the best of each window, exactly."""

    def found(held: list[pa.RecordBatch], asks: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        queries = _unpacked(asks.column("vec"), kind, wide)
        askers = list(zip(*[asks.column(n).to_pylist() for n in ("vec_id", "label", "lows", "highs")]))
        for block in held:
            for at in range(0, block.num_rows, _SLICE):
                rows = block.slice(at, _SLICE)
                ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
                table = _products(queries, _unpacked(rows.column("vec"), kind, wide))
                for (asker, label, lows, highs), scores in zip(askers, table):
                    for window, (low, high) in enumerate(zip(lows, highs)):
                        if low <= high:
                            fits = _fitting(scores, ids, labels, asker, label, low, high, same)
                            best = _best(scores, ids, fits, most)
                            out += [(asker, window, i, s) for i, s in zip(ids[best].tolist(), scores[best].tolist())]
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["asker", "window", "found", "score"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            keys, kinds = (batch.column(n).to_numpy() for n in ("key", "kind"))
            cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(kinds) != 0)) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(keys)]):
                part = batch.slice(begin, end - begin)
                if keys[begin] != key:
                    key, held = keys[begin], []
                if kinds[begin] == 0:
                    held.append(part.select(["vec_id", "label", "vec"]))
                else:
                    for at in range(0, part.num_rows, _ASKED):
                        yield from found(held, part.slice(at, _ASKED))

    return answer


def search(index: Index, asks: DataFrame, same: bool, most: int) -> DataFrame:
    """(asker, window, rank, found, score): the `most` best rows in each of the windows of `asks` (vec_id, label,
    vec, lows, highs), of the asker's label (`same`) or of another. Exact; ties by smaller id.

    Rows are shuffled once, by block, with the anchors that ask for each; a task holds one block.
    """
    parts = (index.tree, index.kind, index.first_key, index.sample)
    rows = index.rows.selectExpr(
        "key", "0 AS kind", "vec_id", "label", "vec",
        "CAST(NULL AS array<long>) AS lows", "CAST(NULL AS array<long>) AS highs",
    )
    met = (
        rows.unionByName(asks.mapInArrow(_asked(parts, same, most), _ASK))
        .repartitionByRange("key")
        .sortWithinPartitions("key", "kind")
    )
    answers = met.mapInArrow(
        _answered(index.kind, index.tree.wide, same, most), "asker long, window int, found long, score long"
    )
    order = W.partitionBy("asker", "window").orderBy(F.desc("score"), "found")
    return answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 10,
    percent: tuple[int, int] = (30, 90),
    **tree: int,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `rows` has vec_id, label and embedding. Components become floor(scale * x); a score is an inner product. Each anchor's
    `positives` best rows of its label are its positives; for each, the `negatives` best rows of other labels whose score
    is between percent[0] and percent[1] hundredths of the positive's. Higher scores come first, ties by smaller vec_id.

    Rows with a NULL vec_id, label or vector, or with a component that is NULL or not finite, take no part, nor do vectors
    so long that their scores are no longs. Shorter vectors count as filled with 0. Repeated rows are found as often as
    they are there; rows with an anchor's vec_id are not its positives, and of several anchors with one vec_id
    that with the least label, then the least bytes of its vector asks. An empty table gives no rows. Other columns are not read.
    """
    index = build_index(rows, is_anchor, scale, **tree)
    if index is None:
        return rows.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    least, most = -(1 << 62), 1 << 62
    anchors = saved(
        index.rows.filter("anchor")
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "vec")).alias("own"))
        .select("vec_id", "own.*"),
        "anchors",
    )
    asks = anchors.select("*", F.array(F.lit(least)).alias("lows"), F.array(F.lit(most)).alias("highs"))
    near = saved(search(index, asks, True, positives), "positives")
    low, high = percent
    windows = near.groupBy("asker").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("best"))
    wide = "CAST(b.score AS DECIMAL(20, 0))"
    asks = anchors.join(windows, F.col("vec_id") == F.col("asker")).select(
        *anchors.columns,
        F.expr(f"transform(best, b -> CAST(ceil({wide} * {low} / 100) AS long))").alias("lows"),
        F.expr(f"transform(best, b -> CAST(floor({wide} * {high} / 100) AS long))").alias("highs"),
    )
    far = search(index, asks, False, negatives).select(
        "asker", "window", "rank", F.col("found").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = near.select(
        F.col("asker").alias("anchor_id"),
        (F.col("rank") - 1).alias("nth"),
        F.col("found").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return far.join(named, (F.col("asker") == F.col("anchor_id")) & (F.col("window") == F.col("nth"))).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
