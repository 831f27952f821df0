"""Classifiers by their accuracy on held-out documents, the tokenizer by parity and round trip."""

from __future__ import annotations

import inspect
import random
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from oracle import MEDIUM
from pyspark.sql import functions as F

import __spark_entry__ as driver
from starflow.llm import language_id, rows, toxicity
from starflow.llm import sentencepiece_tokens as tokens
from starflow.llm.queries import SENTENCEPIECE_MODEL
from starflow.llm.sentencepiece_tokens import Codec, Model, build, decode, encode, parse

MODEL = Path(SENTENCEPIECE_MODEL).read_bytes() if Path(SENTENCEPIECE_MODEL).exists() else None


def test_languages_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    rows = driver.queries()["op3_language_id"](spark, MEDIUM).collect()
    assert {r.doc_id for r in rows} == set(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_rows(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").filter("doc_id < 60")
    model = language_id.train(docs, per_language=10)
    got = language_id.identify(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    und = {(r.doc_id, r.score) for r in got if r.lang_pred == "und"}
    assert und == {(None, 0.0), (2, 0.0), (3, 0.0), (4, 0.0)}
    untrained = language_id.train(no_docs)
    assert untrained is None and language_id.train(odd_docs) is None
    assert {r.lang_pred for r in language_id.identify(odd_docs, untrained).collect()} == {"und"}
    assert language_id.identify(no_docs, model).collect() == []


def test_windows_cover_every_byte():
    texts = ["", "x", "a" * 256, "b" * 257, "é" * 1000]
    taken, row, size = language_id.windows(pa.array(texts, pa.large_string()))
    for i, text in enumerate(texts):
        data = text.encode()
        of = np.flatnonzero(row == i)
        covered = np.zeros(len(data), bool)
        for n, w in enumerate(of):
            begin = n * language_id.STRIDE
            assert taken[w, : size[w]].tobytes() == data[begin : begin + size[w]]
            assert not taken[w, size[w] :].any()
            covered[begin : begin + size[w]] = True
        assert covered.all()


def test_network_slopes_equal_differences():
    draw = np.random.default_rng(1)
    model = language_id.ByteCnn(["a", "b", "c"], embed=3, filters=2)
    for part in ("embed", "kernel", "shift", "out", "bias", "reach"):
        setattr(model, part, getattr(model, part).astype(np.float64))
    taken, labels = draw.integers(0, 256, (4, 256)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss():
        patches, response = model._pooled(taken)
        features = np.maximum(response.max(axis=1) + model.shift, 0)
        p = model._softmax(features @ model.out + model.bias)
        return -np.log(p[np.arange(4), labels]).mean()

    slopes = model._slopes(taken, labels)
    for part, slope in slopes.items():
        values = getattr(model, part)
        for _ in range(6):
            at = tuple(draw.integers(0, n) for n in values.shape)
            if part == "kernel" and not model.reach[at]:
                continue
            kept, step = values[at], 1e-6
            values[at] = kept + step
            above = loss()
            values[at] = kept - step
            below = loss()
            values[at] = kept
            assert slope[at] == pytest.approx((above - below) / (2 * step), abs=1e-5)


def _labelled(n, seed):
    """Toxic documents hold one of some words, which differ in their ends."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(draw.randint(3, 80))]
        toxic = i % 4 == 0
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(["zorgling", "Zorglers", "vexwort", "vexworts!"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_of_held_out_documents(spark):
    df = spark.createDataFrame(_labelled(800, 1), "doc_id long, text string, toxic int")
    train = df.filter("doc_id % 5 <> 0")
    model = toxicity.train(df.drop("toxic"), train.select("doc_id", "toxic"))
    scored = toxicity.toxicity(df, model).join(df, "doc_id").collect()
    assert all(0 <= r.score <= 1 for r in scored)
    assert np.mean([(r.score >= 0.5) == r.toxic for r in scored if r.doc_id % 5 == 0]) > 0.97


def test_toxicity_query_learns_from_known_labels_only(spark):
    got = driver.queries()["op7_toxicity"](spark, MEDIUM).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    clean = [r for r in got if toxic.get(r.doc_id) == 0]
    assert np.mean([r.predicted for r in clean]) < 0.05
    assert all(r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    df = spark.createDataFrame(_labelled(200, 2), "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic").union(spark.sql("SELECT 4L, CAST(NULL AS int)")).withColumn("text", F.lit(1))
    model = toxicity.train(df, labels)
    got = toxicity.toxicity(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    empty = {r.score for r in got if r.doc_id in (2, 3)}
    assert len(empty) == 1
    kept = toxicity.with_toxicity(odd_docs, model, "fresh")
    assert kept.columns == [*odd_docs.columns, "fresh"] and kept.count() == odd_docs.count()
    assert toxicity.toxicity(no_docs, model).collect() == []
    one_label = toxicity.train(df, df.filter("toxic = 0"))
    assert {r.score < 0.1 for r in toxicity.toxicity(odd_docs, one_label).collect()} == {True}
    none = toxicity.train(no_docs, labels)
    assert {r.score for r in toxicity.toxicity(odd_docs, none).collect()} == {0.5}


def test_ngrams_stay_in_their_text():
    texts = pa.array(["abcde", "", "ab", "cde", "x"], pa.large_string())
    data, row_at = toxicity._flat(texts)
    for order in (3, 4, 5):
        buckets, inside = toxicity.ngram_buckets(data, row_at[1:], order)
        starts = np.flatnonzero(inside)
        expected = [row_at[i] + j for i, t in enumerate(texts.to_pylist()) for j in range(len(t) - order + 1)]
        assert starts.tolist() == expected


def test_ngrams_of_a_block_that_begins_with_empty_texts():
    for texts in (["", "abcdefg"], ["", "", "abcde", "x"], ["a", "abcdef"], ["ab", "", "abcdef"], [""]):
        data, row_at = toxicity._flat(pa.array(texts, pa.large_string()))
        for order in (3, 4, 5):
            _, inside = toxicity.ngram_buckets(data, row_at[1:], order)
            expected = [row_at[i] + j for i, t in enumerate(texts) for j in range(len(t) - order + 1)]
            assert np.flatnonzero(inside).tolist() == expected


needs_model = pytest.mark.skipif(MODEL is None, reason="no model file")


@needs_model
def test_encoding_and_decoding_equal_the_original_library():
    import sentencepiece

    original = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    draw = random.Random(1)
    signs = "ab \n\t▁  éß梦😀\x00\r<s></s><unk><0x0A>.,'THE the"
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(1500)]
    texts += ["", " ", "  ", "\n", "<s>", "</s> x", "<0x0A>", "▁", "a▁b", " x", "a" * 3000, "x  y   z"]
    codec = Codec(MODEL)
    ids = codec.encode(texts)
    assert ids == [original.encode(t) for t in texts]
    assert codec.decode(ids) == [original.decode(x) for x in ids]


def _message(fields):
    """Fields (number, value) of the wire format, for a small model."""
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            import struct

            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        elif isinstance(value, int):
            key = number << 3
            while key > 127:
                out, key = out + bytes([key & 127 | 128]), key >> 7
            out += bytes([key, value])
        else:
            data = value if isinstance(value, bytes) else value.encode()
            out += bytes([number << 3 | 2, len(data)]) + data
    return out


def test_a_unigram_model_takes_the_best_lattice_path():
    pieces = [("<unk>", 0.0, 2), ("▁a", -1.0, 1), ("b", -2.0, 1), ("▁ab", -2.5, 1), ("c", -1.5, 1), ("bc", -5.0, 1)]
    parts = [(1, _message([(1, p), (2, s), (3, k)])) for p, s, k in pieces]
    data = _message([*parts, (2, _message([(3, 1)])), (3, _message([(3, 1), (4, 1), (5, 1)]))])
    model = parse(data)
    assert isinstance(model, Model) and [p for p, _, _ in model.pieces] == [p for p, _, _ in pieces]
    tokenizer = build(model)
    assert [tokenizer.encode(t, add_special_tokens=False).tokens for t in ("abc", "  ab  ")] == [["▁ab", "c"], ["▁ab"]]


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_a_unigram_model_takes_no_piece_that_is_not_normal(byte_fallback):
    import io

    import sentencepiece

    draw, written = random.Random(3), io.BytesIO()
    lines = ["".join(draw.choices("abcde <>/sunk0x41", k=40)) for _ in range(300)]
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(lines), model_writer=written, model_type="unigram", minloglevel=2,
        vocab_size=340 if byte_fallback else 60, byte_fallback=byte_fallback, hard_vocab_limit=False,
    )
    model = written.getvalue()
    original = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = ["<s>", "a</s>b", "<unk> x", "<0x41>", "b <0x41><s>", "abc de"]
    assert Codec(model).encode(texts) == [original.encode(t) for t in texts]


@needs_model
def test_every_text_is_verified_and_ids_decode_to_texts(spark, odd_docs, no_docs):
    assert inspect.signature(encode).parameters["verify"].default == 1
    encoded = encode(odd_docs, MODEL)
    ids = encoded.select("doc_id", "ids").union(spark.createDataFrame([(77, None)], "doc_id long, ids array<int>"))
    got = Counter((r.doc_id, r.text) for r in decode(ids, MODEL).collect())
    assert got == Counter([(r.doc_id, r.text or "") for r in odd_docs.select("doc_id", "text").collect()] + [(77, None)])
    assert decode(encode(no_docs, MODEL), MODEL).collect() == []


@needs_model
def test_round_trip_of_whole_texts(spark, odd_docs, no_docs):
    got = encode(odd_docs, MODEL, verify=1).collect()
    assert len(got) == odd_docs.count()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3)} == {0}
    assert encode(no_docs, MODEL).collect() == []
    rows = driver.queries()["op8_sentencepiece"](spark, MEDIUM).collect()
    assert len(rows) == 1000 and all(r.round_trip for r in rows)


@needs_model
def test_words_encoded_once_equal_whole_texts(monkeypatch):
    """Blanks side by side and at the ends, metaspaces, bytes, broken pieces of special tokens, and a small store of words."""
    monkeypatch.setattr(tokens, "KEPT_WORDS", 50)
    monkeypatch.setattr(tokens, "_TOGETHER", 7)
    codec = tokens.Codec(MODEL, 1)
    assert codec.by_word
    draw = random.Random(4)
    parts = [*"abc  éß日\n\t　▁😀\x00", "<s>", "</s>", "<0x41>", "<unk>", "the", " ", "﻿", "é", "ﬁ"]
    for _ in range(20):
        texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(200)]
        ids, decoded = codec.both_ways(pa.array(texts, pa.large_string()))
        whole = codec.encode(texts)
        assert ids.to_pylist() == whole and decoded == codec.decode(whole)
        assert len(codec.kept) <= 50


def test_what_a_worker_keeps_does_not_grow(spark):
    """The codec and the words it keeps are made once in a process and stay below their bound."""
    from starflow.llm import rows

    made = []
    for _ in range(3):
        rows.held_by_process("test of what is kept", lambda: made.append(1) or made)
    assert made == [1]
    kept = rows.Lately(10)
    for n in range(1000):
        assert kept[n] is None
        kept[n] = str(n)
        kept.tidy()
        assert len(kept) <= 10 and len(kept.older) <= 11
    assert kept[999] == "999"


def test_toxicity_holds_little_at_a_time():
    """A batch of many texts costs what a small part of it does, and what another operator's task kept is freed."""
    draw = random.Random(5)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=2000)) for _ in range(1000)]
    batch = pa.record_batch({"doc_id": pa.array(range(1000)), "label": pa.array([i % 2 for i in range(1000)], pa.int32()), "text": texts})
    rows.held_by_process("codec", lambda: "kept by an earlier task")
    tracemalloc.start()
    counted = list(toxicity._counts(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(x.num_rows for x in counted) > 10_000
    assert peak < 60e6, peak
    assert rows.held_by_process("codec", lambda: "made anew") == "made anew"
    rows.let_go()
