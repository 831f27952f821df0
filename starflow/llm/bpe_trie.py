"""BPE encoding and decoding over a trie of distinct words.

The last token of a word's prefix and the prefix before that token determine the prefix's whole
encoding. So the encoding of a word is a chain of states, one a character: the last token there.
Words that begin alike share those states: distinct words go into a trie, and a walk in
depth-first order finds each node's state once, from those above it.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import Lately, blocks, documents, held_by_process, per_distinct

# A word's last character and the end of the word are one symbol, the character this much further on.
_END = 0x1000
# Words, and texts between blanks, kept from block to block in a worker process: two halves of
# this many each, none longer.
KEPT_WORDS, KEPT_LENGTH = 300_000, 64
_KEPT_PAIRS = 1_000_000
# Bytes of text encoded at a time, and words a trie holds: neighbours in order, which begin alike.
_BLOCK, _TRIE_WORDS = 1 << 22, 1 << 14
# White space of some kind other than those that texts are split at.
_ODD_BLANK = re.compile(r"[^\S ]|[\x1c-\x1f\x85]")


class Merges:
    """The tokens and merges of a BPE model. Words are texts of symbols, one character each."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        self.suffix = suffix
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.ids = {self._symbols(token): i for token, i in vocab.items()}
        for rank, pair in enumerate(merges):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, made = vocab[left], vocab[right], vocab[left.removesuffix(suffix or "\0") + right]
            if made in self.parts:
                raise ValueError(f"merge {rank} makes what another does")
            self.rank[a, b] = rank
            self.parts[made] = (a, b, rank)
        if any(max(self._made(a), self._made(b)) >= rank for (a, b), rank in self.rank.items()):
            raise ValueError("a merge uses what a later merge makes")
        self.ids = {s: i for s, i in self.ids.items() if len(s) == 1 or self._whole(i)}
        self.begun = {s[:n] for s in self.ids for n in range(1, len(s) + 1)} | {""}
        self.ends: dict[str, _Ends] = {}
        self.apart: dict[int, bool] = {}

    def _symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            token = token.removesuffix(self.suffix)
            return token[:-1] + chr(ord(token[-1]) + _END)
        return token

    def word(self, text: str) -> str:
        """A word of the pre-tokenizer as symbols."""
        return text[:-1] + chr(ord(text[-1]) + _END) if self.suffix else text

    def _made(self, token: int) -> int:
        return self.parts[token][2] if token in self.parts else -1

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """What stands at an edge of the token while it is merged, with the rank that ends it."""
        found, until = [(token, float("inf"))], 0.0
        while token in self.parts:
            until, token = self.parts[token][2], self.parts[token][side]
            found.append((token, until))
        return found

    def _joined(self, a: int, b: int, before: float) -> bool:
        """Whether a merge across the border of a and b comes first, at a rank below `before`.

        Lower ranks go first, and of equal ones the left: a merge that ends a's last part
        at the same rank lies further left, one that ends b's first part further right.
        """
        lefts, rights = self._edge(a, 1), self._edge(b, 0)
        return any(
            rank < min(gone, before) and rank <= until
            for x, gone in lefts
            for y, until in rights
            if (rank := self.rank.get((x, y))) is not None
        )

    def _whole(self, token: int) -> bool:
        """Whether the token's own text is encoded as the token; others never appear."""
        if token not in self.parts:
            return False
        todo = [token]
        while todo:
            part = todo.pop()
            if part in self.parts:
                a, b, rank = self.parts[part]
                if self._joined(a, b, rank):
                    return False
                todo += [a, b]
        return True

    def stay_apart(self, pair: int) -> bool:
        """Whether a text of two tokens, given as one number, is encoded as just these two."""
        if len(self.apart) >= _KEPT_PAIRS:
            self.apart.clear()
        found = self.apart[pair] = not self._joined(pair >> 32, pair & 0xFFFFFFFF, float("inf"))
        return found

    def after(self, text: str) -> _Ends:
        """The longest end of the text that begins a token, with the tokens that end the text."""
        while text not in self.begun:
            text = text[1:]
        held = self.ends.get(text)
        if held is None:
            held = self.ends[text] = _Ends(
                text,
                [(n, self.ids[text[-n:]]) for n in range(len(text), 0, -1) if text[-n:] in self.ids],
            )
        return held


class _Ends:
    """The end of a prefix: what of it can go on as a token, and the tokens there, longest first."""

    __slots__ = ("text", "tokens", "next")

    def __init__(self, text: str, tokens: list[tuple[int, int]]) -> None:
        self.text = text
        self.tokens = tokens
        self.next: dict[str, _Ends] = {}


class Trie:
    """Distinct words by their common beginnings: a node is a dictionary of its next symbols.

    Beyond DEEP symbols words share nothing: the rest of a word is kept whole at its node, so that a
    word of a million characters costs no million of nodes.
    """

    DEEP = 256

    def __init__(self) -> None:
        self.root: dict = {}
        self.n = 0

    def insert(self, word: str) -> None:
        """Adds a word, whose number is how many were added before."""
        node = self.root
        for symbol in word[: self.DEEP]:
            below = node.get(symbol)
            if below is None:
                below = node[symbol] = {}
            node = below
        node.setdefault("", []).append((self.n, word[self.DEEP :]))
        self.n += 1

    def encode(self, merges: Merges) -> list[bytes]:
        """Token ids of the words by number, as 4-byte numbers: one depth-first walk.

        On the way down, `last` and `begin` have the last token at each depth and where it begins, and
        `ends` what ends there.
        """
        found: list[bytes] = [b""] * self.n
        known, settle, after = merges.apart.get, merges.stay_apart, merges.after
        last, begin, ends = [0], [0], [after("")]
        todo = [(self.root, 0, "")]
        while todo:
            node, depth, symbols = todo.pop()
            here = node.get("")
            # What lies beyond DEEP is a path of its own for each word.
            paths = [(number, symbols + rest) for number, rest in here] if here else [(-1, symbols)]
            for number, path in paths:
                at = depth - len(symbols)
                del last[at + 1 :], begin[at + 1 :], ends[at + 1 :]
                state = ends[at]
                for symbol in path:
                    at += 1
                    nearby = state.next.get(symbol)
                    if nearby is None:
                        nearby = state.next[symbol] = after(state.text + symbol)
                    state = nearby
                    for size, token in state.tokens:
                        if size == at:
                            break
                        pair = last[at - size] << 32 | token
                        apart = known(pair)
                        if apart or apart is None and settle(pair):
                            break
                    else:
                        raise ValueError(f"no token ends in {symbol!r}")
                    last.append(token)
                    begin.append(at - size)
                    ends.append(state)
                if number >= 0:
                    own = []
                    while at:
                        own.append(last[at])
                        at = begin[at]
                    own.reverse()
                    found[number] = array("i", own).tobytes()
            for symbol, below in node.items():
                if symbol:
                    while len(below) == 1 and "" not in below:  # no branch: go on at once
                        ((more, below),) = below.items()
                        symbol += more
                    todo.append((below, depth + len(symbol), symbol))
        return found


class Names:
    """The tokens by id, all that decoding needs."""

    def __init__(self, spec: dict) -> None:
        if spec["decoder"]:
            raise ValueError("only tokenizers that join tokens by blanks are supported")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: token for token, i in {**spec["model"]["vocab"], **added}.items()}
        self.tokens = pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.large_string())

    def decode(self, ids: pa.Array) -> pa.LargeStringArray:
        """The texts of lists of token ids: the tokens, joined by blanks. Unknown ids give nothing."""
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        known = (flat >= 0) & (flat < len(self.tokens))
        known[known] = (pc.binary_length(self.tokens).to_numpy(zero_copy_only=False) > 0)[flat[known]]
        ends = np.concatenate(([0], np.cumsum(known)))[np.concatenate(([0], np.cumsum(sizes)))]
        tokens = pa.LargeListArray.from_arrays(pa.array(ends), self.tokens.take(pa.array(flat[known])))
        return pc.binary_join(tokens, pa.scalar(" ", pa.large_string()))


class Codec:
    """Encodes and decodes as the tokenizers library does with the same file.

    The library's own normalizer and pre-tokenizer make words of a text; they must cut at
    white space and drop it. Tokens, merges and the joining of tokens are done here.
    """

    def __init__(self, content: bytes) -> None:
        from tokenizers import Tokenizer

        spec = json.loads(content)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or spec["post_processor"]:
            raise ValueError(f"only plain BPE models are supported: {odd}")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that reach beyond their own text are not supported")
        library = Tokenizer.from_str(content.decode())
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        if [p for p, _ in self._pieces("ab \t c")] != ["ab", "c"]:
            raise ValueError("words must end at white space and not hold it")
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
            if self.added
            else None
        )
        self.names = Names(spec)
        self.kept_chunks, self.kept_words = Lately(KEPT_WORDS), Lately(KEPT_WORDS)

    def _pieces(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return self.pre_tokenizer.pre_tokenize_str(text)

    def _split(self, chunks: list[str]) -> list[list[str]]:
        """The words of each chunk; chunks hold no blanks. All at once where blanks keep them apart."""
        plain, joined = chunks, " ".join(chunks)
        if _ODD_BLANK.search(joined):
            plain = [c for c in chunks if not _ODD_BLANK.search(c)]
            joined = " ".join(plain)
        normal = self.normalizer.normalize_str(joined) if self.normalizer is not None else joined
        found: dict[str, list[str]] = {}
        parts = normal.split(" ")
        if len(parts) == len(plain):
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
            pieces = self.pre_tokenizer.pre_tokenize_str(normal)
            words = [word for word, _ in pieces]
            begins = np.fromiter((span[0] for _, span in pieces), np.int64, len(pieces))
            cuts = np.searchsorted(begins, ends).tolist()
            found = {c: words[a:b] for c, a, b in zip(plain, [0, *cuts], cuts)}
        return [found[c] if c in found else [p for p, _ in self._pieces(c)] for c in chunks]

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Token ids of distinct words. Those seen lately are looked up; the others go into tries."""
        kept = self.kept_words
        found = {word: kept[word] for word in words}
        missing = sorted(word for word, ids in found.items() if ids is None)
        new: dict[str, bytes] = {}
        for at in range(0, len(missing), _TRIE_WORDS):
            part = missing[at : at + _TRIE_WORDS]
            trie = Trie()
            for word in part:
                trie.insert(self.merges.word(word))
            new.update(zip(part, trie.encode(self.merges)))
        kept.update((word, ids) for word, ids in new.items() if len(word) <= KEPT_LENGTH)
        kept.tidy()
        found.update(new)
        return found

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Token ids of distinct chunks without blanks, as 4-byte numbers."""
        special: dict[str, list[str]] = {}
        if self.added_pattern is not None and self.added_pattern.search(" ".join(chunks)):
            cuts = {c: [p for p in self.added_pattern.split(c) if p] for c in chunks}
            special = {c: parts for c, parts in cuts.items() if not set(parts).isdisjoint(self.added)}
        texts = [c for c in chunks if c not in special]
        texts += dict.fromkeys(p for parts in special.values() for p in parts if p not in self.added)
        words = dict(zip(texts, self._split(texts)))
        ids = self._encode_words(list(dict.fromkeys(w for own in words.values() for w in own)))
        ids_of = ids.__getitem__
        found = {text: b"".join(map(ids_of, own)) for text, own in words.items()}
        own_id = {token: array("i", [i]).tobytes() for token, i in self.added.items()}
        for chunk, parts in special.items():
            found[chunk] = b"".join(own_id.get(p) or found[p] for p in parts)
        return [found[c] for c in chunks]

    def chunks(self, distinct: list[str]) -> list[bytes]:
        """Token ids of distinct chunks; those seen lately are looked up."""
        kept = self.kept_chunks
        found = {c: kept[c] for c in distinct}
        missing = [c for c, ids in found.items() if ids is None]
        new = dict(zip(missing, self._encode_chunks(missing) if missing else ()))
        kept.update((c, ids) for c, ids in new.items() if len(c) <= KEPT_LENGTH)
        kept.tidy()
        found.update(new)
        return [found[c] for c in distinct]

    def encode(self, texts: pa.LargeStringArray) -> pa.LargeListArray:
        """Token ids of each text."""
        collecting = gc.isenabled()
        gc.disable()  # millions of nodes, none in a cycle
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: pa.LargeStringArray) -> pa.LargeListArray:
        ids, _ = per_distinct(pc.ascii_split_whitespace(texts), self.chunks)
        return ids

    def decode(self, ids: pa.Array) -> pa.LargeStringArray:
        """The texts of lists of token ids."""
        return self.names.decode(ids)


def _codec(content: bytes) -> Codec:
    return held_by_process(f"bpe {hashlib.sha256(content).hexdigest()}", lambda: Codec(content))


def _names(content: bytes) -> Names:
    return held_by_process(f"names {hashlib.sha256(content).hexdigest()}", lambda: Names(json.loads(content)))


def _encoded(content: bytes, decoded: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(content)
        for batch, texts in blocks(batches, size=_BLOCK):
            ids = codec.encode(texts)
            sizes = pc.list_value_length(ids).cast(pa.int64())
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": sizes, "ids": ids.cast(pa.list_(pa.int32()))}
            if decoded:
                columns["text"] = codec.decode(ids).cast(pa.string())
            yield pa.record_batch(columns)
        pa.default_memory_pool().release_unused()

    return encode


def encode(docs: DataFrame, tokenizer: bytes, decoded: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row of `docs` (doc_id, text); if `decoded`, with `text`, what the ids decode to.

    `tokenizer` is the content of a tokenizers file with a BPE model, which goes to the tasks. Ids are those
    of the library without special tokens added; the texts of special tokens are those tokens,
    as in the library. Whole texts are encoded, in blocks of about 4 MB or one longer text, and nothing
    is shuffled; a word of any length is one path of the trie. NULL and empty texts have no tokens. Rows
    without doc_id, repeated rows and other columns change nothing; an empty table gives no rows.
    """
    kinds = "doc_id long, n_tokens long, ids array<int>" + ", text string" * decoded
    return documents(docs).mapInArrow(_encoded(tokenizer, decoded), kinds)


def _decoded(content: bytes, names: list[str]):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = _names(content)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_pylist()
            begin, held = 0, 0
            for row, size in enumerate([*sizes, None]):
                if size is None or held and held + size > 1 << 18:
                    part = batch.slice(begin, row - begin)
                    texts = named.decode(part.column("ids")).cast(pa.string())
                    texts = pc.if_else(pc.is_null(part.column("ids")), pa.scalar(None, pa.string()), texts)
                    yield pa.record_batch([*[part.column(n) for n in names], texts], [*names, "text"])
                    begin, held = row, 0
                held += size or 0

    return decode


def decode(encoded: DataFrame, tokenizer: bytes) -> DataFrame:
    """The rows of `encoded` with `text`, what their `ids` decode to, special tokens included, in place of `ids`.

    NULL ids give a NULL text, and ids that are no token nothing. A column of `encoded` named `text` is replaced.
    """
    rest = encoded.drop("ids", "text")
    names = [f"c{i}" for i in range(len(rest.columns))]
    plain = encoded.select(F.col("ids").cast("array<int>"), *rest.columns).toDF("ids", *names)
    kinds = [f"{n} {kind}" for n, (_, kind) in zip(names, rest.dtypes)]
    texts = plain.mapInArrow(_decoded(tokenizer, names), ", ".join([*kinds, "text string"]))
    return texts.toDF(*rest.columns, "text")
