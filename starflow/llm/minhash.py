"""Near duplicates: fast similarity sketches, bands, exact verification, components.

A fast similarity sketch throws every element of a set into one of t bins, round after
round, each round ranked after all earlier ones, until every bin holds an element; after t
rounds, round t + b offers all elements to bin b, so every bin fills whatever the size of
the set. Two sets agree in a bin about as often as their Jaccard similarity says, with
the concentration of t independent choices, for one pass over most sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm.components import connected_components
from starflow.llm.rows import blocks, documents, let_go, row_key, saved
from starflow.llm.words import Words, distinct_by_row, mix, stream

_UNFILLED = np.uint64(0xFFFFFFFFFFFFFFFF)
_VALUE_BITS = np.uint64(44)
_BLOCK = 128  # sets that are compared with as many others at once
_TEXT_BLOCK = 1 << 19  # bytes of text that are made into sets at once


def fast_similarity_sketch(values: np.ndarray, first: np.ndarray, t: int) -> np.ndarray:
    """Sketches of many sets at once, one row of t coordinates each.

    `values[first[i]:first[i+1]]` are the distinct 64-bit elements of set i. A coordinate
    is the round and the element's value in it. Rows of empty sets stay unfilled.
    """
    n_sets = len(first) - 1
    sizes = np.diff(first)
    sketch = np.full((n_sets, t), _UNFILLED, np.uint64)
    flat = sketch.reshape(-1)
    seeds = stream(77, 2 * t)
    live, owner = values, np.repeat(np.arange(n_sets), sizes)
    pending = sizes > 0
    for r in range(2 * t):
        if not len(live):
            break
        hashed = mix(live ^ seeds[r])
        rank = (np.uint64(r) << _VALUE_BITS) | (hashed & ((np.uint64(1) << _VALUE_BITS) - np.uint64(1)))
        if r < t:
            bins = ((hashed >> _VALUE_BITS) * np.uint64(t) >> (np.uint64(64) - _VALUE_BITS)).astype(np.int64)
        else:
            bins = np.full(len(live), r - t, np.int64)
        np.minimum.at(flat, owner * t + bins, rank)
        still = pending & (sketch == _UNFILLED).any(axis=1)
        if not np.array_equal(still, pending):
            keep = still[owner]
            live, owner, pending = live[keep], owner[keep], still
    return sketch


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of `rows` coordinates."""
    n, t = sketch.shape
    parts = sketch[:, : t // rows * rows].reshape(n, t // rows, rows)
    keys = np.broadcast_to(stream(78, t // rows), parts.shape[:2]).copy()
    for j in range(rows):
        keys = mix(keys * np.uint64(3) ^ parts[:, :, j])
    return keys


def _sets(texts: pa.LargeStringArray, words: int) -> tuple[np.ndarray, np.ndarray]:
    found = Words(texts, lower=True)
    values, rows = found.shingles(words)
    return distinct_by_row(values, rows, found.n_rows)


def _digests(values: np.ndarray, first: np.ndarray) -> list[bytes]:
    return [
        hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest()
        for a, b in zip(first[:-1], first[1:])
    ]


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, row, n_shingles, digest of the whole set, band keys) of every document."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch, texts in blocks(batches, size=_TEXT_BLOCK):
            values, first = _sets(texts, words)
            keys = band_keys(fast_similarity_sketch(values, first, bands * rows), rows)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "row": batch.column("row"),
                    "n_shingles": pa.array(np.diff(first)),
                    "digest": pa.array(_digests(values, first), pa.binary()),
                    "keys": pa.FixedSizeListArray.from_arrays(
                        pa.array(keys.reshape(-1).view(np.int64)), bands
                    ).cast(pa.list_(pa.int64())),
                }
            )

    return docs.mapInArrow(
        sketch, "doc_id long, row long, n_shingles long, digest binary, keys array<long>"
    )


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, digest, shingles) of every document: the full set, as 64-bit hashes, in order."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch, texts in blocks(batches, size=_TEXT_BLOCK):
            values, first = _sets(texts, words)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "digest": pa.array(_digests(values, first), pa.binary()),
                    "shingles": pa.LargeListArray.from_arrays(
                        pa.array(first), pa.array(values.view(np.int64))
                    ).cast(pa.list_(pa.int64())),
                }
            )

    return docs.mapInArrow(collect, "doc_id long, digest binary, shingles array<long>")


def _similar(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter(_similar(shared, F.size("of_a"), F.size("of_b"), percent))
    )


def _linked(percent: int):
    """Between two blocks of sets: which components have a similar enough pair."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for i in range(batch.num_rows):
                x, y = batch.column("xs")[i].values, batch.column("ys")[i].values
                c_x, c_y = (z.field("component").to_numpy() for z in (x, y))
                s_x, s_y = x.field("shingles"), y.field("shingles")
                n_x, n_y = (np.diff(z.offsets.to_numpy()) for z in (s_x, s_y))
                tokens = s_y.flatten().to_numpy()
                owner = np.repeat(np.arange(len(n_y)), n_y)
                order = np.argsort(tokens, kind="stable")
                tokens, owner = tokens[order], owner[order]
                found = set()
                for j in range(len(n_x)):
                    own = s_x[j].values.to_numpy()
                    low = np.searchsorted(tokens, own, "left")
                    count = np.searchsorted(tokens, own, "right") - low
                    at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
                    shared = np.bincount(owner[at], minlength=len(n_y))
                    near = (100 * shared >= percent * (n_x[j] + n_y - shared)) & (c_y != c_x[j])
                    found.update((int(c_x[j]), int(c)) for c in np.unique(c_y[near]))
                if found:
                    a, b = zip(*sorted(found))
                    yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _blocked(grouped: DataFrame, sets: DataFrame, size: int, name: str) -> DataFrame:
    """Rows (around, node, component) with their sets, gathered to blocks of about `size` rows."""
    total = grouped.groupBy("around").agg(F.count("*").alias("n"))
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / size))
    return (
        grouped.join(total, "around")
        .join(sets, "node")
        .groupBy("around", block.alias("block"))
        .agg(F.collect_list(F.struct("component", "shingles")).alias(name))
        .select("around", name)
    )


def _rest(members: DataFrame, names: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components for every pair of a bucket that is not yet in one component.

    The component of a bucket that is largest over all is its centre, so that the buckets of one
    group have one centre. Of any such pair, one at least is
    outside the centre; the other is in the centre or outside too. So whatever is outside is
    compared with all of the centre and all that is outside it, block by block.
    """
    named = members.join(names, "node")
    largest = (
        named.join(names.groupBy("component").agg(F.count("*").alias("n")), "component")
        .groupBy("bucket")
        .agg(F.max(F.struct("n", F.col("component").alias("around"))).alias("c"))
        .select("bucket", F.col("c.around").alias("around"))
    )
    outside = saved(
        named.join(largest, "bucket")
        .filter("component <> around")
        .select("around", "node", "component")
        .distinct(),
        "outside",
    )
    inside = names.join(
        outside.select(F.col("around").alias("component")).distinct(), "component"
    ).select(F.col("component").alias("around"), "node", "component")
    xs = _blocked(outside, sets, _BLOCK, "xs")
    ys = _blocked(inside.union(outside), sets, _BLOCK, "ys")
    return xs.join(ys, "around").mapInArrow(_linked(percent), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = 40,
    rows: int = 6,
    pivot_rounds: int = 2,
) -> DataFrame:
    """(doc_id, row, n_shingles, component_id, kept) of every row of `docs` (doc_id, text).

    Documents are linked where their sets of `words`-word shingles have a Jaccard
    similarity of `percent` or more, confirmed on the full sets; a component is named by its
    smallest doc_id, whose row is kept. `bands` bands of `rows` coordinates miss a pair at 0.8
    with probability (1 - 0.8**6)**40, 5 in a million, and fewer above.

    Rows with equal sets are one node, its smallest doc_id, and only that goes on. Of buckets
    with the same nodes one stays. The nodes of a bucket are not paired with one another: in each
    pivot round every bucket draws one node, and only nodes not yet in its component
    are compared with it, so a bucket of m linked nodes costs about m comparisons. What is still
    apart then is compared exactly, block by block (_rest), and only links between
    components come out. So no two nodes that share a bucket and end in different
    components have gone uncompared.

    NULL and empty texts have the empty set and are linked with nothing. A row without
    doc_id is linked with nothing and kept, with a NULL component_id. Rows that repeat a
    doc_id are judged one by one, by their text, of which `row` is a hash, but two texts whose nodes are the same doc_id
    count as linked. Repeated rows give equal results.
    """
    docs = documents(docs).withColumn("row", row_key())
    drawn = saved(sketches(docs, words, bands, rows), "sketches")
    linkable = drawn.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = saved(
        linkable.groupBy("digest").agg(
            F.min("doc_id").alias("node"), F.max("n_shingles").alias("n_shingles")
        ),
        "classes",
    )
    bucketed = (
        linkable.join(classes.select("digest", "node"), "digest")
        .filter("doc_id = node")
        .select("node", F.explode("keys").alias("bucket"))
    )
    crowded = (
        bucketed.groupBy("bucket")
        .agg(
            F.min("node").alias("low"),
            F.max("node").alias("high"),
            F.count("*").alias("size"),
            # Sums of 32 bits, which repeated rows don't cancel and which can't overflow.
            F.expr("sum(xxhash64(node) & 4294967295)").alias("mark"),
            F.expr("sum(xxhash64(1, node) & 4294967295)").alias("mark2"),
        )
        .filter("low < high")
        .groupBy("low", "high", "size", "mark", "mark2")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "size")
    )
    members = saved(bucketed.join(crowded, "bucket").distinct(), "members")

    nodes = saved(classes.join(members.select("node").distinct(), "node"), "nodes")
    wanted = nodes.select(F.col("node").alias("doc_id")).distinct()
    sets = saved(
        shingle_sets(docs.join(wanted, "doc_id"), words)
        .withColumnRenamed("doc_id", "node")
        .join(nodes.select("node", "digest"), ["node", "digest"], "left_semi")
        .dropDuplicates(["node"])
        .select("node", "shingles", F.size("shingles").alias("n")),
        "sets",
    )
    sized = sets.select("node", "n")
    shingled = sets.select("node", "shingles")

    names = sized.select("node", F.col("node").alias("component"))
    for r in range(pivot_rounds + 1):
        if r == pivot_rounds:
            links = saved(_rest(members.filter("size > 2"), names, shingled, percent), "links")
        else:
            # A bucket of two is settled by the first round.
            open_ = members if r == 0 else members.filter("size > 2")
            named = open_.join(names, "node").join(sized, "node")
            draw = F.struct(F.xxhash64("node", F.lit(r)).alias("draw"), "node", "n", "component")
            # Written, so that the join has plain shuffles on both sides, which AQE can split.
            pivots = saved(
                named.groupBy("bucket").agg(F.min(draw).alias("p")).select(
                    "bucket",
                    F.col("p.node").alias("a"),
                    F.col("p.n").alias("n_a"),
                    F.col("p.component").alias("c_a"),
                ),
                "pivots",
            )
            pairs = (
                named.withColumnRenamed("node", "b")
                .join(pivots, "bucket")
                .filter("component <> c_a")
                .filter(_similar(F.least("n_a", "n"), F.col("n_a"), F.col("n"), percent))
                .select("a", "b", "c_a", F.col("component").alias("c_b"))
                .distinct()
            )
            found = _confirmed(pairs, shingled, percent)
            links = saved(
                found.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")).distinct(), "links"
            )
        if links.isEmpty():
            continue
        merged = connected_components(links).select(
            F.col("node").alias("component"), F.col("component").alias("into")
        )
        names = saved(
            names.join(merged, "component", "left").select(
                "node", F.coalesce("into", "component").alias("component")
            ),
            "names",
        )
    component = names.withColumnRenamed("component", "smallest")
    labelled = classes.join(component, "node", "left").select(
        "digest", F.coalesce("smallest", "node").alias("smallest")
    )
    return (
        drawn.join(labelled, "digest", "left")
        .select(
            "doc_id",
            "row",
            "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id"))
            .when(F.col("doc_id").isNotNull(), F.col("smallest"))
            .alias("component_id"),
        )
        .withColumn(
            "kept", F.col("component_id").isNull() | (F.col("component_id") == F.col("doc_id"))
        )
    )
