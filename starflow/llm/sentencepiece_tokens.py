"""SentencePiece encoding and decoding with the tokenizers library as backend.

The model file, a protobuf, is read here field by field, and what it says is rebuilt: the
normaliser, the metaspace marker, the pieces with their scores (a unigram lattice, or merges in the
order of their scores for a BPE model), and byte fallback.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.rows import Lately, blocks, documents, held_by_process, per_distinct

SPACE = "▁"
# Words kept from block to block in a worker process: two halves of this many, none longer; bytes of a block.
KEPT_WORDS, KEPT_LENGTH = 160_000, 64
_BLOCK = 1 << 21
# Words that are encoded as one text.
_TOGETHER = 1 << 11
# Fixed values of the model format: kinds of pieces, kinds of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a message; nested messages and strings as bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 1:
            value, at = data[at : at + 8], at + 8
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind == 5:
            value, at = struct.unpack("<f", data[at : at + 4])[0], at + 4
        else:
            raise ValueError(f"not a SentencePiece model: wire type {kind}")
        yield key >> 3, value


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True


def parse(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            model.pieces.append((piece.get(1, b"").decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
            if trainer.get(24, 0):
                raise ValueError("models that treat white space as a suffix are not supported")
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix = bool(spec.get(3, 1))
            model.remove_extra = bool(spec.get(4, 1))
            model.escape = bool(spec.get(5, 1))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that make up a piece, best score first; of equal ones, by the left part's id."""
    place = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, score, kind in model.pieces:
        if kind == NORMAL:
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in place and right in place:
                    found.append((-score, place[left], place[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build(model: Model):
    """A tokenizer of the tokenizers library that encodes and decodes as the model does."""
    from tokenizers import AddedToken, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == UNIGRAM:
        # No text holds a space once spaces are escaped, so these pieces keep their ids and match nothing.
        hidden = {CONTROL: "{} ", UNUSED: "{} ", UNKNOWN: " ⁇ "} if model.escape else {}
        core = models.Unigram(
            [(hidden.get(kind, "{}").format(p) if kind in hidden else p, score) for p, score, kind in model.pieces],
            unknown,
            model.byte_fallback,
        )
    else:
        core = models.BPE(
            {p: i for i, (p, _, _) in enumerate(model.pieces)},
            _merges(model),
            unk_token=model.pieces[unknown][0] if unknown is not None else None,
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra:
        steps += [normalizers.Strip(), normalizers.Replace(_pattern(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", SPACE))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    if not any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _, _ in model.pieces):
        # No piece reaches over the beginning of a word, so words are encoded by themselves.
        tokenizer.pre_tokenizer = pre_tokenizers.Split(_pattern(f"{SPACE}*[^{SPACE}]+|{SPACE}+"), "isolated")
    tokenizer.add_tokens(
        [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER_DEFINED and p.strip(SPACE)]
    )
    parts = [decoders.Replace(SPACE, " ")]
    if model.byte_fallback:
        parts.append(decoders.ByteFallback())
    parts.append(decoders.Fuse())
    if model.dummy_prefix:
        parts.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(parts)
    return tokenizer


def _pattern(text: str):
    from tokenizers import Regex

    return Regex(text)


class Codec:
    """Encodes and decodes batches, with as many threads as asked for."""

    def __init__(self, model: bytes, threads: int = 2) -> None:
        # Read by the library when it first runs a batch in this process.
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        parsed = parse(model)
        self.control = np.array([kind == CONTROL for _, _, kind in parsed.pieces])
        self.tokenizer = build(parsed)
        self.original = None
        if parsed.kind == UNIGRAM and (parsed.byte_fallback or not parsed.escape):
            # Byte pieces have to keep their names, so the lattice takes them where a text spells them
            # out. Such texts are left to the original library.
            import sentencepiece

            self.original = sentencepiece.SentencePieceProcessor(model_proto=model)
            self.spelled = re.compile("|".join(re.escape(p) for p, _, kind in parsed.pieces if kind not in (NORMAL, USER_DEFINED)))

        # Where every blank begins a word and nothing else is changed, words are encoded by themselves, each
        # distinct one once.
        self.by_word = (
            parsed.kind == BPE
            and self.tokenizer.pre_tokenizer is not None
            and parsed.escape
            and parsed.dummy_prefix
            and not parsed.remove_extra
            and not parsed.charsmap
            and not any(kind == USER_DEFINED for _, _, kind in parsed.pieces)
        )
        self.kept = Lately(KEPT_WORDS)
        pieces = [p for p, _, _ in parsed.pieces]
        self.begins = np.array([p.startswith(SPACE) for p in pieces])
        # Tokens that decode to their own text, with blanks for metaspaces, or to a byte.
        self.plain = np.array([kind in (NORMAL, BYTE) for _, _, kind in parsed.pieces])
        self.shown = pa.array(
            [
                bytes([int(p[1:-1], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode()
                for p, _, kind in parsed.pieces
            ],
            pa.large_binary(),
        )
        self.one_blank_off = parsed.dummy_prefix and parsed.escape

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, each with the blank before it, as 4-byte numbers."""
        found = {w: self.kept[w] for w in words}
        missing = [w for w, known in found.items() if known is None]
        for at in range(0, len(missing), 16 * _TOGETHER):
            # Some thousand words are one text; each begins with the only piece that has a metaspace ahead.
            parts = [missing[i : i + _TOGETHER] for i in range(at, min(at + 16 * _TOGETHER, len(missing)), _TOGETHER)]
            for part, made in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
                ids = np.array(made.ids, np.int32)
                cuts = np.flatnonzero(self.begins[ids])
                if len(cuts) == len(part) and cuts[0] == 0:
                    raw, ends = ids.tobytes(), [*(4 * cuts[1:]).tolist(), 4 * len(ids)]
                    own = [raw[a:b] for a, b in zip([0, *ends], ends)]
                else:
                    own = [array("i", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                new = dict(zip(part, own))
                found.update(new)
                self.kept.update((w, x) for w, x in new.items() if len(w) <= KEPT_LENGTH)
        self.kept.tidy()
        return [found[w] for w in words]

    def _texts(self, ids: pa.LargeListArray) -> list[str]:
        """What lists of ids decode to. Tokens that stand for their text or a byte are joined; where that is no text, or there
        are others, the library decodes."""
        flat, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
        tokens = pa.LargeListArray.from_arrays(ids.offsets, self.shown.take(pa.array(flat)))
        joined = pc.binary_join(tokens, pa.scalar(b"", pa.large_binary())).to_pylist()
        odd = np.concatenate(([0], np.cumsum(~self.plain[flat])))
        others = set(np.flatnonzero(odd[ends[1:]] > odd[ends[:-1]]).tolist())
        texts = []
        for row, raw in enumerate(joined):
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                others.add(row)
                text = ""
            texts.append(text[1:] if self.one_blank_off and text[:1] == " " else text)
        rows = sorted(others)
        for row, text in zip(rows, self.decode([flat[ends[r] : ends[r + 1]].tolist() for r in rows])):
            texts[row] = text
        return texts

    def both_ways(self, texts: pa.LargeStringArray) -> tuple[pa.LargeListArray, list[str]]:
        """Token ids of each text, and what they decode to."""
        # A text with blanks side by side, at an end, or with metaspaces of its own is encoded whole.
        odd = pc.or_(pc.match_substring_regex(texts, f"^ |  | $|{SPACE}"), pc.equal(texts, "")).to_numpy(zero_copy_only=False)
        if not self.by_word or odd.all():
            ids = self.encode(texts.to_pylist())
            return pa.array(ids, pa.large_list(pa.int32())), self.decode(ids)
        ids, _ = per_distinct(pc.split_pattern(texts.filter(pa.array(~odd)), " "), self._words)
        if odd.any():
            whole = pa.array(self.encode(texts.filter(pa.array(odd)).to_pylist()), pa.large_list(pa.int32()))
            order = np.empty(len(odd), np.int64)
            order[~odd], order[odd] = np.arange(len(ids)), len(ids) + np.arange(len(whole))
            ids = pa.concat_arrays([ids, whole]).take(pa.array(order))
        return ids, self._texts(ids)

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if self.original is not None:
            for i, text in enumerate(texts):
                if self.spelled.search(unicodedata.normalize("NFKC", text)):
                    ids[i] = self.original.encode(text)
        return ids

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def _codec(model: bytes, threads: int) -> Codec:
    digest = hashlib.sha256(model).hexdigest()
    return held_by_process(f"pieces {digest} {threads}", lambda: Codec(model, threads))


def _original(model: bytes):
    import sentencepiece

    digest = hashlib.sha256(model).hexdigest()
    return held_by_process(f"original {digest}", lambda: sentencepiece.SentencePieceProcessor(model_proto=model))


def _encoded(model: bytes, threads: int, verify: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, threads)
        reference = _original(model) if verify else None
        for batch, texts in blocks(batches, size=_BLOCK):
            plain = texts.to_pylist()
            ids, decoded = codec.both_ways(texts)
            ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            for row, text in enumerate(plain) if verify else ():
                # Chosen by their content, so that a rerun checks the same texts.
                if verify == 1 or hashlib.blake2b(text.encode(), digest_size=4).digest()[0] % verify == 0:
                    if not np.array_equal(reference.encode(text), flat[ends[row] : ends[row + 1]]):
                        raise ValueError(f"encoding differs from the model's: {text[:80]!r}")
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array(np.diff(ends).astype(np.int64)),
                    "ids": ids.cast(pa.list_(pa.int32())),
                    "decoded_sha256": pa.array(
                        [hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()
                    ),
                    "round_trip": pa.array([a == b for a, b in zip(plain, decoded)]),
                }
            )
        pa.default_memory_pool().release_unused()  # the worker stays, for whatever comes next

    return encode


def encode(docs: DataFrame, model: bytes, threads: int = 2, verify: int = 1) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256, round_trip) of every row of `docs` (doc_id, text).

    `model` is a SentencePiece model file's content, which goes to the tasks as it is. Whole texts are encoded
    in batches of about 2 MB of text on `threads` threads, and decoded again; `round_trip` says
    whether that gives the text back, which a model that normalises need not do. One text in
    `verify`, chosen by its content (1: every text, 0: none), is also encoded by the sentencepiece library, and
    any difference is an error. NULL and empty texts have no tokens. Rows without doc_id and repeated rows
    are encoded like others.
    """
    return documents(docs).mapInArrow(
        _encoded(model, threads, verify),
        "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string, round_trip boolean",
    )


def _decoded(model: bytes, threads: int):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, threads)
        for batch in batches:
            rows, held = 0, 0
            sizes = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_pylist()
            for row, size in enumerate([*sizes, None]):
                if size is None or held and held + size > 1 << 18:
                    part = batch.slice(rows, row - rows)
                    ids = part.column("ids").to_pylist()
                    texts = iter(codec.decode([x for x in ids if x is not None]))
                    made = [None if x is None else next(texts) for x in ids]
                    yield pa.record_batch(
                        {"doc_id": part.column("doc_id"), "text": pa.array(made, pa.string())}
                    )
                    rows, held = row, 0
                held += size or 0

    return decode


def decode(encoded: DataFrame, model: bytes, threads: int = 2) -> DataFrame:
    """(doc_id, text) of every row of `encoded` (doc_id, ids), as `encode` gives them. NULL ids give a NULL text."""
    return encoded.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")
    ).mapInArrow(_decoded(model, threads), "doc_id long, text string")
