"""BPE over a trie against the tokenizers library, on the tables, odd texts and random ones."""

from __future__ import annotations

import hashlib
import json
import random
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import MEDIUM
from tokenizers import Tokenizer

from starflow.llm import bpe_trie
from starflow.llm import queries as llm

CONTENT = Path(llm.BPE_TOKENIZER).read_bytes()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(CONTENT.decode())


@pytest.fixture(scope="module")
def codec():
    return bpe_trie.Codec(CONTENT)


def as_library(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def digests(doc_id, ids, text):
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text)]
    return (doc_id, len(ids), *sha)


def test_query_equals_the_library(spark, library):
    found = llm.op11_bpe_trie(spark, MEDIUM)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    table = pq.read_table(f"{MEDIUM}/documents.parquet").to_pylist()
    want = {digests(r["doc_id"], *as_library(library, r["text"])) for r in table}
    assert {tuple(r) for r in found.collect()} == want


def test_odd_documents(spark, library, odd_docs, no_docs):
    rows = bpe_trie.decode(bpe_trie.encode(odd_docs, CONTENT), CONTENT).collect()
    want = [(r.doc_id, *as_library(library, r.text)) for r in odd_docs.collect()]
    assert sorted(((r.doc_id, r.n_tokens, r.text) for r in rows), key=str) == sorted(
        ((doc, len(ids), text) for doc, ids, text in want), key=str
    )
    ids = bpe_trie.encode(odd_docs, CONTENT).collect()
    assert sorted((str(r.doc_id), r.ids) for r in ids) == sorted((str(d), i) for d, i, _ in want)
    assert bpe_trie.decode(bpe_trie.encode(no_docs, CONTENT), CONTENT).collect() == []


PARTS = [
    *"abcxyzTHEing0123 \t\n\r\x0b\x0c.,!?'_-", *"ÀéßΣσςİıſǅ日本語한국어ㅎ😀👍🏽ﬁΩ",
    "　", "\xa0", "\x85", "\x1c", "​", " ", "́", "̈́", "̣", "é", "가", "\x00",
    "<|endoftext|>", "<|startoftext|>", "<|", "|>", "the", "ing", "'ll", "'RE", "aaaa", "ำ", "ﷺ",
]


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_equal_the_library(library, codec, seed):
    draw = random.Random(seed)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 60))) for _ in range(2000)]
    ids = codec.encode(pa.array(texts, pa.large_string()))
    assert list(zip(ids.to_pylist(), codec.decode(ids).to_pylist())) == [as_library(library, t) for t in texts]


def test_very_long_words(library, codec):
    draw = random.Random(2)
    texts = ["ab" * 300_000, "x" * 200_001, "".join(draw.choices("aeinrst", k=100_000)), "y" * 300 + "z", "y" * 300]
    ids = codec.encode(pa.array(texts, pa.large_string())).to_pylist()
    assert ids == [as_library(library, t)[0] for t in texts]


def test_words_that_begin_alike_share_their_nodes(codec):
    trie = bpe_trie.Trie()
    for word in ("walk", "walks", "walked", "wall"):
        trie.insert(codec.merges.word(word))

    def nodes(node):
        return 1 + sum(nodes(below) for symbol, below in node.items() if symbol)

    # w, a, l, and the words' ends: k, k-s, k-e-d, l
    assert nodes(trie.root) == 1 + 3 + 1 + 1 + 1 + 2 + 1


def test_what_is_kept_from_block_to_block_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe_trie, "KEPT_WORDS", 20)
    monkeypatch.setattr(bpe_trie, "_KEPT_PAIRS", 30)
    codec, draw = bpe_trie.Codec(CONTENT), random.Random(3)
    for _ in range(50):
        texts = ["".join(draw.choices(PARTS, k=30)) for _ in range(20)]
        got = codec.encode(pa.array(texts, pa.large_string())).to_pylist()
        assert got == [as_library(library, t)[0] for t in texts]
        assert len(codec.kept_words) <= 20 and len(codec.merges.apart) <= 30


def small_model(merges, suffix):
    """A tokenizer over a, b and c, whose merges need not be those of training."""
    letters = [*"abc", *(x + suffix for x in "abc" if suffix)]
    made = [a + b for a, b in merges]
    spec = json.loads(CONTENT)
    spec["model"]["vocab"] = {t: i for i, t in enumerate(dict.fromkeys([*letters, *made]))}
    spec["model"]["merges"] = [list(m) for m in merges]
    spec["model"]["end_of_word_suffix"] = suffix or None
    spec["added_tokens"] = []
    return json.dumps(spec).encode()


@pytest.mark.parametrize("seed", range(12))
def test_small_models_equal_the_library(seed):
    """Runs of one symbol, merges that reach over tokens, tokens that their own text does not give."""
    draw = random.Random(seed)
    suffix = "</w>" if seed % 2 else ""
    tokens, merges, made = [*"abc"], [], set()
    while len(merges) < 14:
        a, b = draw.choice(tokens), draw.choice(tokens)
        if len(a + b) <= 6 and a + b not in made:
            merges.append((a, b))
            made.add(a + b)
            tokens.append(a + b)
            if suffix and draw.random() < 0.6 and a + b + suffix not in made:
                base = b + suffix
                if len(b) == 1 or base in made:
                    merges.append((a, base))
                    made.add(a + base)
    content = small_model(merges, suffix)
    library, codec = Tokenizer.from_str(content.decode()), bpe_trie.Codec(content)
    texts = ["".join(draw.choices("abc", k=n % 24)) for n in range(1500)]
    got = codec.encode(pa.array(texts, pa.large_string())).to_pylist()
    assert got == [library.encode(t).ids for t in texts]


def test_models_that_cannot_be_carried_out_are_refused():
    bad = json.loads(CONTENT)
    bad["model"]["merges"] = [["ab", "c"], ["a", "b"]]
    bad["model"]["vocab"] = {"a": 0, "b": 1, "c": 2, "ab": 3, "abc": 4}
    with pytest.raises(ValueError, match="merge"):
        bpe_trie.Codec(json.dumps(bad).encode())
    bad["model"]["dropout"] = 0.1
    with pytest.raises(ValueError, match="dropout"):
        bpe_trie.Codec(json.dumps(bad).encode())


def test_ids_that_are_no_token(spark):
    table = spark.createDataFrame([(1, [0, -1, 10**6, 1]), (2, None), (3, [])], "doc_id long, ids array<int>")
    rows = bpe_trie.decode(table, CONTENT).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == [(1, '! "'), (2, None), (3, "")]
