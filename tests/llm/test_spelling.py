"""Spelling variants against plain pairwise comparison."""

import collections
import random
import re
import zlib

import pytest

from cdclake.llm import spelling
from tests.llm.cases import documents, empty


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def vocabulary(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def grouped(counts):
    found = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best and counts[best] >= 10 * n else None
        found[w] = [form, n, len(near), counts[form] if form else None]
    for w, row in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        row.insert(1, root)
    return {w: tuple(row) for w, row in found.items()}


def collected(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    found = {r["word"]: tuple(r)[1:] for r in rows}
    assert len(found) == len(rows)
    return found


def random_words(rng, count, letters="ab", lengths=(7, 10)):
    return {"".join(rng.choice(letters) for _ in range(rng.randint(*lengths))) for _ in range(count)}


def test_acceptor_numbers_words_and_shares_states():
    words = sorted(random_words(random.Random(1), 200))
    machine = spelling.Acceptor(words)
    for number, word in enumerate(words):
        q, at = machine.start, 0
        for c in word:
            q, before = machine.arc_of[q][c]
            at += before
        assert machine.final[q] and at == number
    continuations = [
        (machine.final[q], tuple((c, t) for c, t, _ in machine.arcs[q])) for q in range(len(machine.arcs))
    ]
    assert len(set(continuations)) == len(continuations)


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_pairs_of_a_machine(letters):
    words = sorted(random_words(random.Random(2), 300, letters, (1, 5)))
    found = list(spelling.one_edit_pairs(words))
    assert len({frozenset(p) for p in found}) == len(found)
    assert {frozenset(p) for p in found} == {
        frozenset((i, j)) for i in range(len(words)) for j in range(i) if one_edit(words[i], words[j])
    }
    assert all(len(words[i]) <= len(words[j]) for i, j in found)


@pytest.mark.parametrize("most", [1, 4, 20_000])
def test_variants_of_a_vocabulary(spark, most):
    """Partitions of any size give the same; with a bound of 1 every one is halved as far as it goes."""
    rng = random.Random(3)
    words = random_words(rng, 150) | {"a" * k for k in range(7, 12)} | {"é" * 8, "é" * 7 + "x", "b" * 3000, "b" * 3001}
    counts = {w: rng.choice([2, 3, 25, 40, 300, 5000]) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert collected(spelling.variants(frame, most)) == grouped(counts)


@pytest.mark.parametrize("most", [1, 20_000])
def test_equally_frequent_near_words_of_two_lengths(spark, most):
    """Near words are ranked whole: what one of them begins another with, less the ending they share, does not decide."""
    counts = {"ababbbbbb": 25, "abbbbbbbb": 5000, "abbabbbbbb": 5000, "accbabbab": 2, "acbbabbab": 40, "accabbabbab": 3}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert collected(spelling.variants(frame, most)) == grouped(counts)


def test_chains_of_forms(spark):
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000, "aabbbbb": 200000}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = collected(spelling.variants(frame))
    assert found == grouped(counts)
    assert found["aaaaaaa"][1] == "aabbbbb"


def test_words_of_documents(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    words = spelling.words_of_documents(docs)
    assert {r["word"]: r["n"] for r in words.collect()} == vocabulary(rows)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    common = ["straight", "strength", "Übergabe", "colourés", "question", "although"]
    rows = []
    for i in range(400):
        words = [rng.choice(common) for _ in range(30)]
        for k in range(0, 30, 10):
            w = words[k]
            at = rng.randrange(len(w))
            words[k] = w[:at] + rng.choice(["", "e", w[at] * 2]) + w[at + 1 :]
        rows.append((i, "".join(w + rng.choice([" ", ", ", "\n", "1"]) for w in words)))
    rows += [(None, "straight STRAIGHT strenght strenght"), (400, None), (401, ""), rows[0], rows[0]]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = collected(spelling.op13_spelling_variants(spark, str(tmp_path)))
    assert found == grouped(vocabulary(rows))
    assert any(r[0] for r in found.values())


def test_empty(spark):
    assert spelling.variants(spelling.words_of_documents(empty(spark))).count() == 0
