"""A run-length index of a repetitive collection of byte strings, held in one task.

The Burrows-Wheeler transform of the collection, each string ended by a mark of
its own, is kept as runs, with the suffix positions sampled at the first row of
each run and at the row before it, the last of the run above. Along a run the
longest match with the suffix above shrinks by one character a step, so those
samples and the matches at the starts of runs determine the matching statistics
of the whole collection against itself: position ``s + d`` matches
``above + d`` over ``length - d`` characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from cdclake.llm.hashing import prefix_hashes, span_hashes


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """All suffixes in order, by doubling the compared length; only suffixes still equal are sorted again.

    A suffix's rank is the first place of its group, so a group is refined in its own places.
    """
    n = len(symbols)
    order = np.argsort(symbols)
    rank, places, step = np.empty(n, np.int64), np.arange(n), 1
    key = symbols[order].astype(np.int64)
    while True:
        first = np.ones(len(places), bool)
        first[1:] = key[1:] != key[:-1]
        rank[order[places]] = places[np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))]
        equal = ~first
        equal[:-1] |= ~first[1:]
        places = places[equal]
        if not len(places):
            return order
        at = order[places]
        # Ranks are below 2 ** 31, so a pair of them is one sortable number.
        key = rank[at] << 32
        inside = at + step < n
        key[inside] |= rank[at[inside] + step] + 1
        again = np.argsort(key)
        order[places], key = at[again], key[again]
        step *= 2


@dataclass
class RunIndex:
    """Runs of the transform: the symbol of each, and the suffixes at its start and just above it."""

    symbols: np.ndarray
    heads: np.ndarray
    starts: np.ndarray
    above: np.ndarray
    lengths: np.ndarray

    @classmethod
    def build(cls, strings: list[bytes]) -> RunIndex:
        marks = len(strings)
        sizes = np.fromiter(map(len, strings), np.int64, marks)
        codes = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8)
        ends = np.cumsum(sizes + 1) - 1
        symbols = codes.astype(np.int64) + marks
        symbols[ends] = np.arange(marks)
        order = suffix_order(symbols)
        before = symbols[order - 1]
        run = np.flatnonzero(before[1:] != before[:-1]) + 1
        starts, above = order[run], order[run - 1]
        return cls(symbols, before[run], starts, above, _common(codes, ends, starts, above))

    def matches(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, place above and length of the matches of at least ``least`` at the starts of runs."""
        long = self.lengths >= least
        return self.starts[long], self.above[long], self.lengths[long]


def _common(codes: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many characters the suffixes at ``a`` and ``b`` share before either's string ends."""
    sums = prefix_hashes(codes)
    most = np.minimum(*(ends[np.searchsorted(ends, x)] - x for x in (a, b)))
    low, high = np.zeros(len(a), np.int64), most
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = span_hashes(sums, a, a + middle) == span_hashes(sums, b, b + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def repeated_bytes(strings: list[bytes], least: int) -> list[list[tuple[int, int]]]:
    """Of each string the spans covered by substrings of ``least`` bytes that start at two places or more."""
    sizes = np.fromiter((len(s) + 1 for s in strings), np.int64, len(strings))
    starts = np.cumsum(sizes) - sizes
    s, above, length = RunIndex.build(strings).matches(least)
    change = np.zeros(int(sizes.sum()) + 1, np.int64)
    for at in (s, above):
        np.add.at(change, at, 1)
        np.add.at(change, at + length, -1)
    covered = np.diff(np.concatenate([[False], np.cumsum(change) > 0, [False]]).astype(np.int8))
    first, last = np.flatnonzero(covered == 1), np.flatnonzero(covered == -1)
    found: list[list[tuple[int, int]]] = [[] for _ in strings]
    for a, b, k in zip(first, last, np.searchsorted(starts, first, "right") - 1):
        found[k].append((int(a - starts[k]), int(b - starts[k])))
    return found
