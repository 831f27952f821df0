"""Words of a block of texts as arrays: where they are, and a 64-bit hash of each.

A word is a run of characters other than space and U+0009 to U+000D. All of those are
single bytes in UTF-8, so words are found in the bytes, for all texts of a block at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARKS = _SPACE.copy()  # everything in ASCII but letters and digits
_MARKS[:128] = [not chr(c).isalnum() for c in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_STEP = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        at = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 20)
        return mix(at * np.uint64(_STEP))


def _bases(seed: int) -> tuple[np.ndarray, int, int]:
    """Values of the bytes, an odd base and its inverse modulo 2**64."""
    values = stream(seed, 257)
    base = (int(values[256]) & ~7) | 3
    return values[:256], base, pow(base, -1, 1 << 64)


class _Powers:
    """Powers of a base modulo 2**64, kept, and grown where needed."""

    def __init__(self) -> None:
        self.held: dict[int, np.ndarray] = {}

    def __reduce__(self):  # a task begins with none
        return (type(self), ())

    def __call__(self, base: int, n: int) -> np.ndarray:
        held = self.held.get(base)
        if held is None or len(held) < n:
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            held = np.multiply.accumulate(steps)
            if n <= 1 << 22:  # those of a very long text are not kept
                self.held[base] = held
        return held[:n]


_power = _Powers()


def run_sums(hashes: np.ndarray):
    """A function from begins and ends of runs of words to hashes of the runs."""
    _, base, inverse = _bases(5)
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _power(base, n), out=sums[1:])
    undo = _power(inverse, n + 1)

    def between(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[begin]) * undo[begin] + (end - begin).astype(np.uint64))

    return between


class Words:
    """The words of a block of texts, in order."""

    def __init__(self, texts: pa.LargeStringArray, lower: bool = False, marks: bool = True) -> None:
        """`lower` takes A-Z for a-z; without `marks`, words are runs of letters, digits and
        characters beyond ASCII instead."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[
            texts.offset : texts.offset + len(texts) + 1
        ]
        data = texts.buffers()[2]
        held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        self.data = held[offsets[0] : offsets[-1]]
        self.row_at = offsets - offsets[0]
        if lower:
            self.data = _LOWER[self.data]
        self.n_rows = len(texts)
        n = len(self.data)
        inside = ~(_SPACE if marks else _MARKS)[self.data]
        breaks = np.zeros(n + 1, bool)
        breaks[self.row_at] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | breaks[:-1]))
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (~after | breaks[1:])) + 1
        self.first = np.searchsorted(self.start, self.row_at)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(self.n_rows), self.count)

    def hashes(self, seed: int = 1) -> np.ndarray:
        """A hash of each word's bytes; equal words have equal ones in every block."""
        values, base, inverse = _bases(seed)
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[self.data] * _power(base, n), out=sums[1:])
        raw = (sums[self.end] - sums[self.start]) * _power(inverse, n + 1)[self.start]
        return mix(raw + (self.end - self.start).astype(np.uint64))

    def runs(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of k words that lies in one text, and where it starts."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + n]
        at = np.flatnonzero(self.row[:n] == self.row[k - 1 :])
        return mix(total[at] + np.uint64(k)), at

    def shingles(self, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text of every run of k words; of a text with fewer, all its words as one."""
        hashes = self.hashes(seed)
        values, at = self.runs(hashes, k)
        found, rows = [values], [self.row[at]]
        for n in range(1, k):
            short = np.flatnonzero(self.count == n)
            if len(short):
                total = np.zeros(len(short), np.uint64)
                for j in range(n):
                    total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[self.first[short] + j]
                found.append(mix(total + np.uint64(n)))
                rows.append(short)
        return np.concatenate(found), np.concatenate(rows)


def distinct_by_row(values: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct values in ascending order, and where each row's begin."""
    by_row = np.argsort(rows.astype(np.int32), kind="stable")
    values = values[by_row]
    ends = np.cumsum(np.bincount(rows, minlength=n_rows))
    parts, sizes, at = [], np.zeros(n_rows + 1, np.int64), 0
    for row, end in enumerate(ends):
        part = np.sort(values[at:end])
        if len(part) > 1:
            part = part[np.concatenate(([True], part[1:] != part[:-1]))]
        parts.append(part)
        sizes[row + 1] = len(part)
        at = end
    return np.concatenate(parts) if parts else values, np.cumsum(sizes)


def first_per_value(values: np.ndarray) -> np.ndarray:
    """Mask of one position for each distinct value."""
    order = np.argsort(values, kind="stable")
    mask = np.zeros(len(values), bool)
    ordered = values[order]
    mask[order[np.concatenate(([True], ordered[1:] != ordered[:-1]))] if len(values) else order] = True
    return mask
