"""Locally consistent renaming of word sequences by recompression.

A round replaces every maximal run of one symbol by a symbol for (symbol, length), then
every pair of neighbours of which the first is on the left side and the second on the right by a
symbol for the pair; a hash of the symbol and the round says which side it is on. A new
symbol's name is a 64-bit hash of what it replaces, so equal runs and pairs get the same name in
every task and round without a table of names having to be shuffled.

What a symbol is and where it ends follows from a span of words around it, which is kept
with it. Two equal stretches of words have the same symbols, at the same offsets, wherever the
span lies inside the stretch: these are the stretch's interior symbols.
"""

from __future__ import annotations

import numpy as np

from starflow.llm.words import Words, mix, run_sums, stream


class Level:
    """Symbols in order: names, the text each is in, and the span of words (both ends
    included) that determines it. A span that leaves the text says so by ending outside."""

    def __init__(self, name, row, lo, hi) -> None:
        self.name, self.row, self.lo, self.hi = name, row, lo, hi


def _beside(level: Level, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin of the span of each symbol's left neighbour, end of its right neighbour's;
    a word outside the text where there is none."""
    n = len(level.name)
    left = np.empty(n, np.int64)
    right = np.empty(n, np.int64)
    left[1:] = level.lo[:-1]
    right[:-1] = level.hi[1:]
    new = np.ones(n + 1, bool)
    new[1:-1] = level.row[1:] != level.row[:-1]
    begins, ends = new[:-1], new[1:]
    left[begins] = first[level.row[begins]] - 1
    right[ends] = first[level.row[ends] + 1]
    return left, right


def compress_runs(level: Level, first: np.ndarray) -> Level:
    left, right = _beside(level, first)
    n = len(level.name)
    begins = np.ones(n, bool)
    begins[1:] = (level.name[1:] != level.name[:-1]) | (level.row[1:] != level.row[:-1])
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, n))
    name = level.name[at]
    long = length > 1
    name[long] = mix(name[long] ^ mix(length[long].astype(np.uint64)))
    return Level(name, level.row[at], left[at], right[at + length - 1])


def compress_pairs(level: Level, first: np.ndarray, seed: np.uint64) -> Level:
    left, right = _beside(level, first)
    n = len(level.name)
    is_left = (mix(level.name ^ seed) >> np.uint64(63)).astype(bool)
    paired = np.zeros(n, bool)
    paired[:-1] = is_left[:-1] & ~is_left[1:] & (level.row[:-1] == level.row[1:])
    absorbed = np.zeros(n, bool)
    absorbed[1:] = paired[:-1]
    name = level.name.copy()
    lo = np.where(is_left, level.lo, left)
    hi = np.where(is_left, right, level.hi)
    at = np.flatnonzero(paired)
    name[at] = mix(level.name[at] * np.uint64(0xD6E8FEB86659FD93) + level.name[at + 1] + seed)
    lo[at], hi[at] = level.lo[at], level.hi[at + 1]
    keep = ~absorbed
    return Level(name[keep], level.row[keep], lo[keep], hi[keep])


def recompress(words: Words, hashes: np.ndarray, rounds: int) -> list[Level]:
    """The words as symbols, and the symbols after each round."""
    at = np.arange(len(hashes))
    levels = [Level(hashes, words.row, at, at)]
    for seed in stream(91, rounds):
        if not len(hashes):
            break
        runs = compress_runs(levels[-1], words.first)
        levels.append(compress_pairs(runs, words.first, seed))
    return levels


def _least(priority: np.ndarray, a: np.ndarray, b: np.ndarray, widest: int) -> np.ndarray:
    """Index of the leftmost least priority in each range [a, b), at most `widest` long."""
    found = np.empty(len(a), np.int64)
    size = b - a
    table, width = np.arange(len(priority)), 1
    while width <= widest:
        here = np.flatnonzero((size >= width) & (size < 2 * width))
        if len(here):
            x, y = table[a[here]], table[b[here] - width]
            found[here] = np.where(priority[y] < priority[x], y, x)
        if width < len(table):
            x, y = table[:-width], table[width:]
            table = np.where(priority[y] < priority[x], y, x)
        width *= 2
    return found


def anchors(
    levels: list[Level], starts: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each window of words: the name of its anchor, and the anchor's place.

    A window's anchor is, of the symbols of the highest level that has any inside the
    window, the one with the least hash, the leftmost of equals. It follows from the words
    of the window alone, so equal windows have anchors of one name at one offset. A symbol
    that a few frequent words make up is common; as an anchor it is therefore named
    together with all words of its span, which equal windows share too. The place, unique
    in the block, tells one occurrence of a symbol from another.
    """
    name = np.zeros(len(starts), np.uint64)
    place = np.zeros(len(starts), np.int64)
    todo = np.arange(len(starts))
    n_words = len(levels[0].name)
    base = 0
    between = run_sums(levels[0].name)
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        before = np.cumsum(np.bincount(level.lo + 1, minlength=n_words + 2))  # [s]: spans from before s
        within = np.cumsum(np.bincount(level.hi, minlength=n_words + 2))
        a = before[starts[todo]]
        b = within[starts[todo] + window - 1]
        has = b > a
        here = todo[has]
        if len(here):
            priority = mix(level.name + np.uint64(depth))
            chosen = _least(priority, a[has], b[has], window)
            span = between(level.lo[chosen], level.hi[chosen] + 1)
            name[here] = mix(priority[chosen] ^ span)
            place[here] = base + chosen
        todo = todo[~has]
        base += len(level.name)
        if not len(todo):
            break
    return name, place
