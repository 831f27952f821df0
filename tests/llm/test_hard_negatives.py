"""Hard negatives against all pairs of rows: on the tables (SQL) and on odd vectors; and what the tree leaves out."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from oracle import MEDIUM
from pyspark.sql import functions as F

from starflow.llm import hard_negatives as hn

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute_force(rows, is_anchor, scale=256):
    """All pairs, in whole numbers of any size."""
    kept = []
    for vec_id, label, vector in rows:
        if None in (vec_id, label, vector) or not all(x is not None and math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(scale * float(np.float32(x))) for x in vector]
        if sum(x * x for x in whole) < 1 << 62:
            kept.append((vec_id, label, whole))
    dims = max((len(w) for *_, w in kept), default=0)
    kept = [(i, label, w + [0] * (dims - len(w))) for i, label, w in kept]
    most = max((abs(x) for *_, w in kept for x in w), default=0)
    kind = next(k for k in ("<i2", "<i4", "<i8") if most <= np.iinfo(k).max)
    anchors = {}
    for row in sorted(kept, key=lambda r: (r[1], np.array(r[2], kind).tobytes())):
        if is_anchor(row[0]):
            anchors.setdefault(row[0], row)
    found = []
    for anchor, label, vector in anchors.values():
        scored = sorted(((-sum(a * b for a, b in zip(vector, w)), i, own) for i, own, w in kept))
        positives = [(s, i) for s, i, own in scored if own == label and i != anchor][:5]
        for minus, positive in positives:
            score = -minus
            fits = [(-s, i) for s, i, own in scored if own != label and 30 * score <= -100 * s <= 90 * score]
            found += [(anchor, positive, n + 1, i, score, s) for n, (s, i) in enumerate(fits[:10])]
    return sorted(found)


def test_table_equals_all_pairs(spark):
    """With another share of anchors than the query has."""
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in pq.read_table(f"{MEDIUM}/embeddings.parquet").to_pylist()]
    table = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    found = hn.hard_negatives(table, F.col("vec_id") % 9 == 1)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect())) == brute_force(rows, lambda i: i % 9 == 1)


def odd_rows(seed):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, 5))
    rows = []
    for i in range(400):
        vector = (centres[i % 6] + 0.3 * draw.normal(size=5)).astype(np.float32).tolist()
        rows.append((int(draw.integers(0, 300)) if i % 3 else i, int(draw.integers(0, 4)), vector))
    rows += [(1000 + i, i % 3, [1.0, 0.0, 0.5, 0.0, -1.0]) for i in range(150)]  # one very common vector
    rows += [rows[5]] * 7 + [(7, 1, None), (8, None, [1.0]), (None, 1, [1.0] * 5), (9, 1, []), (10, 2, [2.0, None])]
    rows += [(11, 1, [math.nan] * 5), (12, 1, [math.inf, 0.0]), (13, 1, [0.5, 0.25]), (14, 2, [0.0] * 5)]
    rows += [(15, 1, [1e30] * 5), (16, 0, [3e5, -2e5, 1.0]), (20, 1, [-1.0, 0.0, -0.5, 0.0, 1.0])]
    return rows


def table_of(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    names = "1 AS key, 2 AS kind, 3 AS leaf, 4 AS vec, 5 AS rank, 6 AS `a.b`"
    return table.selectExpr("*", *names.split(", ")).repartition(4)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block", [1 << 17, 16])
def test_odd_vectors_equal_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(hn, "BLOCK_ROWS", block)
    rows = odd_rows(seed)
    found = hn.hard_negatives(table_of(spark, rows), F.col("vec_id") % 10 == 0, sample=60, fan_out=4, depth=3)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, lambda i: i % 10 == 0)


def test_scores_beyond_doubles(spark):
    draw = np.random.default_rng(5)
    rows = [(i, i % 2, (1e6 * (2 + draw.random(4))).astype(np.float32).tolist()) for i in range(60)]
    found = hn.hard_negatives(table_of(spark, rows), F.col("vec_id") % 10 == 0, scale=256)
    want = brute_force(rows, lambda i: i % 10 == 0)
    assert max(r[4] for r in want) > 1 << 53
    assert sorted(map(tuple, found.collect())) == want


def test_no_vectors(spark):
    for rows in ([], [(1, None, [1.0]), (2, 1, None)]):
        found = hn.hard_negatives(table_of(spark, rows), F.lit(True))
        assert found.columns == COLUMNS and found.collect() == []
    alone = hn.hard_negatives(table_of(spark, [(1, 1, [1.0]), (2, 2, [1.0])]), F.lit(True))
    assert alone.collect() == []


def test_tree_leaves_out_and_never_loses():
    draw = np.random.default_rng(0)
    rows = np.floor(256 * (draw.normal(size=(40, 8))[draw.integers(0, 40, 5000)] + 0.1 * draw.normal(size=(5000, 8))))
    tree = hn.Tree(float((rows * rows).sum(axis=1).max()), 8)
    lifted = tree.lifted(rows)
    tree.grow(lifted[:1000], 2, 8, 16)
    tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]

    def see(node, child, far):
        tree.low[node][:, child] = np.minimum(tree.low[node][:, child], far.min(axis=0))
        tree.high[node][:, child] = np.maximum(tree.high[node][:, child], far.max(axis=0))

    leaf = tree.walk(lifted, see)
    queries = rows[::50]
    scores = queries @ rows.T
    tenth = np.sort(scores, axis=1)[:, -10:]
    lows, highs = tenth[:, :1], np.concatenate([tenth[:, 9:] * 0 + 2**60], axis=1)
    reached = tree.reached(queries, lows, highs)
    held = defaultdict(set)
    for query, row in zip(*np.nonzero((scores >= lows) & (scores <= highs))):
        held[query].add(int(leaf[row]))
    assert all(reached[q, at] for q, own in held.items() for at in own)
    assert reached.mean() < 0.5  # a window of ten rows reaches less than half of the leaves
    assert not tree.reached(queries, lows * 0 + 1, lows * 0).any()
