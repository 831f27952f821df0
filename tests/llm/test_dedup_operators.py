from __future__ import annotations

import random

from pyspark.sql import functions as F

from starflow.llm.components import connected_components
from starflow.llm.line_dedup import bitmap_counts, line_bitmaps, without_repeated_lines
from starflow.llm.minhash import fast_similarity_sketch, near_duplicates
from starflow.llm.substring_dedup import remove_repeats


def test_components_equal_union_find(spark):
    draw = random.Random(3)
    edges = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(70)]  # a long chain
    edges += [(2000, 2001 + i) for i in range(300)]  # a hot node
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent}


def test_sketches_fill_and_estimate_similarity():
    import numpy as np

    draw = np.random.default_rng(5)
    values = draw.integers(0, 2**63, 900).astype(np.uint64)
    sets = [values[:500], values[100:600], values[:1], values[:0], values[:3]]
    first = np.cumsum([0, *map(len, sets)])
    sketch = fast_similarity_sketch(np.concatenate(sets), first, 256)
    assert (sketch[[0, 1, 2, 4]] != np.uint64(2**64 - 1)).all()
    assert (sketch[3] == np.uint64(2**64 - 1)).all()
    assert abs((sketch[0] == sketch[1]).mean() - 400 / 600) < 0.12
    assert abs((sketch[2] == sketch[4]).mean() - 1 / 3) < 0.12


def _jaccard_components(texts, k, percent):
    sets = []
    for text in texts:
        words = text.split()
        n = min(k, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set())
    names = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                low, high = sorted((names[i], names[j]))
                names = [low if x == high else x for x in names]
    return names


def test_large_group_of_near_copies_and_outsiders(spark):
    """Copies that differ from each other more than from the original, some beyond the limit."""
    draw = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    texts = [" ".join(f"u{j}x{i}" for i in range(30)) for j in range(20)]
    for j in range(150):
        words = list(base)
        for at in draw.sample(range(120), draw.randint(0, 16)):
            words[at] = f"n{draw.randint(0, 60)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rounds in (0, 2):
        got = near_duplicates(docs, words=2, pivot_rounds=rounds).orderBy("doc_id").collect()
        assert [r.component_id for r in got] == _jaccard_components(texts, 2, 80)


def test_near_duplicates_of_odd_rows(spark, odd_docs, no_docs):
    got = near_duplicates(odd_docs, words=2).collect()
    assert len(got) == odd_docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert sorted(by_id[1]) == [(5, 1, True), (14, 1, True), (14, 1, True)]
    assert by_id[10] == [(14, 1, False)]
    assert [by_id[i] for i in (2, 3, 4)] == [[(0, i, True)] for i in (2, 3, 4)]
    assert by_id[7][0][1:] == (6, False) and by_id[6][0][1:] == (6, True)
    assert {x[1:] for x in by_id[None]} == {(None, True)}
    assert near_duplicates(no_docs).collect() == []


def test_repeats_in_odd_rows(spark, odd_docs, no_docs):
    got = remove_repeats(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id not in (None, 1)}
    assert by_id[2].n_words == by_id[3].n_words == by_id[4].n_words == 0
    assert by_id[8].n_removed == 99 and by_id[8].kept == "na"  # windows 2 to 81 cover words 2 to 100
    assert by_id[7].n_words == 120_001 and by_id[7].kept == "end"
    assert all(r.n_removed == 0 and r.kept is None for r in got if r.doc_id is None)
    assert remove_repeats(no_docs).collect() == []


def test_rounds_change_only_the_work(spark):
    draw = random.Random(4)
    texts = [" ".join(draw.choices("ab", k=draw.randint(0, 90))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    results = [
        sorted(map(tuple, remove_repeats(docs, window=6, rounds=rounds, digest=True).collect()))
        for rounds in (0, 1, 2, 3)
    ]
    assert results.count(results[0]) == 4


def test_lines_of_odd_rows(spark, odd_docs, no_docs):
    maps = {(r.doc_id, r.row): r for r in line_bitmaps(odd_docs).collect()}
    assert len(maps) == 11 and all(doc is not None for doc, _ in maps)
    kept = without_repeated_lines(odd_docs)
    assert kept.columns == odd_docs.columns and kept.schema == odd_docs.schema
    texts = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    # 10 holds the line of 1 in other case; rows without id stay whole, NULL texts NULL.
    assert (10, "") in texts and (2, None) in texts and (None, None) in texts
    assert sum(t is not None and t.startswith("The quick") for _, t in texts) == 3
    assert without_repeated_lines(no_docs).collect() == []


def test_a_hot_line_is_spread_over_ranges(spark):
    """One line in every document: the ranges split it, and one document keeps it."""
    docs = spark.range(3000).select(
        (F.col("id") + 7).alias("doc_id"),
        F.concat(F.lit("a line in all documents\nown line number "), F.col("id")).alias("text"),
    )
    maps = line_bitmaps(docs).collect()
    assert sum(r.n_dropped for r in maps) == 2999
    assert [r.doc_id for r in maps if r.n_dropped == 0] == [7]
    assert bitmap_counts(maps[0].keep, "x\ny") == (2, maps[0].n_dropped)
