"""The run-length index against counting all substrings."""

import collections
import random
import re

import numpy as np

from cdclake.llm.hashing import prefix_hashes, span_hashes
from cdclake.llm.run_index import RunIndex, repeated_bytes, suffix_order
from cdclake.llm.substring_dedup import anchors


def test_suffix_order():
    rng = random.Random(3)
    for _ in range(50):
        text = [0, *[rng.choice((1, 2)) for _ in range(rng.randint(1, 40))]][::-1]
        assert suffix_order(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_bytes():
    rng = random.Random(1)
    for _ in range(300):
        least = rng.choice([1, 2, 3, 5, 8])
        base = bytes(rng.choice(rng.choice([b"a", b"ab", b"abcd"])) for _ in range(30))
        strings = [base[rng.randint(0, 9) : rng.randint(10, 30)] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(5)]
        seen = collections.Counter(s[i : i + least] for s in strings for i in range(len(s) - least + 1))
        want = []
        for s in strings:
            gone = bytearray(len(s))
            for i in range(len(s) - least + 1):
                if seen[s[i : i + least]] > 1:
                    gone[i : i + least] = b"\1" * least
            want.append([m.span() for m in re.finditer(b"\1+", bytes(gone))])
        assert repeated_bytes(strings, least) == want


def test_runs_are_few_on_repetitive_text():
    index = RunIndex.build([b"the same line of text again. " * 40])
    assert len(index.heads) < 60


def test_every_window_has_its_anchor():
    rng = random.Random(2)
    for _ in range(200):
        data = bytes(rng.choice(rng.choice([b"a", b"ab", b"abcdefgh"])) for _ in range(rng.randint(20, 120)))
        gram = rng.choice([3, 5])
        width = 20 - gram + 1
        starts = np.arange(len(data) - gram + 1)
        h = span_hashes(prefix_hashes(np.frombuffer(data, np.uint8)), starts, starts + gram)
        own = {}
        for at, low, high in zip(*anchors(data, 20, gram)[1:]):
            for q in range(low, high + 1):
                assert q not in own
                own[q] = at
        assert own == {
            q: q + max(i for i in range(width) if h[q + i] == h[q : q + width].min()) for q in range(len(data) - 19)
        }
