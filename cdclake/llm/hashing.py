"""Hashes of words and shingles for many texts at once, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

BASE = 0x9E3779B97F4A7C15
#: Characters of text looked at together; a longer text is looked at alone.
SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finishing step of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _byte_values(fold_case: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    if fold_case:
        values[65:91] = values[97:123]
    return values


def prefix_hashes(codes: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any run of bytes."""
    terms = _byte_values(fold_case)[codes] * _powers(BASE, len(codes))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    value = (sums[ends] - sums[starts]) * _powers(pow(BASE, -1, 1 << 64), len(sums))[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def slices(batches: Iterator[pd.DataFrame], column: str = "text", size: int = SLICE) -> Iterator[pd.DataFrame]:
    """The rows of all batches in parts of about ``size`` characters, empty texts for NULL."""
    for batch in batches:
        batch = batch.assign(**{column: [t or "" for t in batch[column]]})
        sizes = np.fromiter(map(len, batch[column]), np.int64, len(batch))
        for _, rows in batch.groupby((np.cumsum(sizes) - sizes) // size, sort=False):
            yield rows


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, A-Z lower-cased, and the number of the text it stands in."""
    parts = [t.encode("utf-8", "replace") for t in texts]
    codes = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
    white = (codes == 32) | ((codes >= 9) & (codes <= 13))
    step = np.diff(np.concatenate([[True], white, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
    bounds = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)))
    return span_hashes(prefix_hashes(codes, True), starts, ends), np.searchsorted(bounds, starts, "right")


def shingle_sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, sorted by text and hash, and the number of their text.

    A text of fewer words than a shingle has one shingle of all its words.
    """
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    weights = [np.uint64(w) for w in mix(np.arange(101, 101 + size, dtype=np.uint64))]
    found, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(words) >= size:
        last = len(words) - size + 1
        total = sum(words[k : k + last] * weights[k] for k in range(size))
        whole = owner[:last] == owner[size - 1 :]
        found, of = total[whole], owner[:last][whole]
    short = (counts < size)[owner]
    if short.any():
        rank = np.arange(len(words)) - (np.cumsum(counts) - counts)[owner]
        sums = np.zeros(len(texts), np.uint64)
        np.add.at(sums, owner[short], words[short] * np.array(weights, np.uint64)[rank[short]])
        few = np.flatnonzero((counts > 0) & (counts < size))
        found = np.concatenate([found, sums[few] + counts[few].astype(np.uint64)])
        of = np.concatenate([of, few])
    found = mix(found)
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    return found[first], of[first]
