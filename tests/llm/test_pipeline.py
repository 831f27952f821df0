from __future__ import annotations

import corpus_pipeline
import pytest
from oracle import MEDIUM
from pyspark.sql import functions as F

import __spark_entry__ as driver
from starflow.llm.queries import SENTENCEPIECE_MODEL


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage was given and returned."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.saved(stage(spark, docs, MEDIUM), name)
        found[name] = (docs, out)
        docs = out
    return found


def test_stages_are_in_order_and_keep_columns(spark, steps):
    assert list(steps) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "tokens"]
    for name, (before, after) in list(steps.items())[:-1]:
        assert after.dtypes == before.dtypes, name


def test_lines_and_counts_follow_the_texts(spark, steps):
    before, after = steps["line_dedup"]
    assert after.count() == before.count()
    assert after.filter("n_chars <> length(text)").isEmpty()
    texts = {r.doc_id: r.text for r in before.collect()}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower()
    owner = {}
    for doc_id in sorted(texts):
        for line in texts[doc_id].split("\n"):
            if len(line.strip(" \t\n\x0b\x0c\r")) >= 10:
                owner.setdefault(key(line), doc_id)
    for r in after.collect():
        kept = [x for x in texts[r.doc_id].split("\n") if owner.get(key(x), r.doc_id) == r.doc_id]
        assert r.text == "\n".join(kept)


def test_one_of_each_group_stays(spark, steps):
    before, after = steps["near_dedup"]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    sets = {}
    for doc_id, text in rows:
        words = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
        n = min(5, len(words))
        sets[doc_id] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    holders, name = {}, {d: d for d in sets}
    for doc_id, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(doc_id)
    pairs = {(a, b) for held in holders.values() if len(held) < 200 for i, a in enumerate(held) for b in held[i + 1 :]}
    for a, b in pairs:
        shared = len(sets[a] & sets[b])
        if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
            low, high = sorted((name[a], name[b]))
            name = {d: low if x == high else x for d, x in name.items()}
    assert {r.doc_id for r in after.collect()} == {d for d, x in name.items() if d == x}


def test_leaking_documents_go_and_others_stay(spark, steps):
    before, after = steps["decontamination"]
    leaks = corpus_pipeline.find_leaks(before, spark.read.parquet(f"{MEDIUM}/benchmark.parquet"))
    gone = {r.doc_id for r in leaks.collect()}
    assert gone and {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - gone


def test_exactly_the_leaking_rows_go(spark):
    passage = spark.read.parquet(f"{MEDIUM}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, passage), (None, "clean"), (None, None), (1, passage), (1, "clean too"), (2, "x " + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.drop_leaks(spark, docs, MEDIUM).collect()
    assert {tuple(r) for r in left} == {(None, "clean"), (None, None), (1, "clean too")} and len(left) == 3


def test_all_that_is_left_is_encoded(spark, steps):
    before, after = steps["tokens"]
    assert after.count() == before.count() and after.filter("NOT round_trip").isEmpty()
    run = driver.queries()["pipeline"](spark, MEDIUM)
    assert sorted(map(str, run.collect())) == sorted(map(str, after.collect()))


def test_stages_take_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs.withColumn("n_chars", F.col("n_chars").cast("long")), no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, MEDIUM)
            if name != "tokens":
                assert out.dtypes == docs.dtypes, name
            assert out.count() <= docs.count()


pytestmark = pytest.mark.skipif(
    not __import__("os").path.exists(SENTENCEPIECE_MODEL), reason="no model file"
)
