"""Spelling variants of a vocabulary: words one edit apart, found by composing finite-state machines.

The pairs sought are what the composition of the vocabulary's acceptor, a
transducer of exactly one edit and the acceptor again accepts. It is enumerated a
partition of initial states at a time. Of two words one edit apart, the shorter
of T characters, either the first half of T is the same in both, or, the first
halves differing, the last T less that half. So a word stands in a partition for
each half, as the shorter and as the longer word: the states that a fixed
beginning leads to, or, read from the other end, a fixed ending. A partition of
more than ``PARTITION`` words is halved in the same way between its beginning and
its ending until it is small; no word or pair is dropped, and each pair is found
in exactly one partition.

Within a partition the words, less what they share, make a minimised acceptor
that numbers them: states with equal continuations are one, and each arc knows
how many words come before those beyond it. The composition walks the acceptor
along one path up to the edit and along two, in step, after it, carrying the two
numbers, so no word is spelled out. An inserted character is taken where the
words first differ, which makes it unique.

Only counts leave a partition: a row per word, with its near words counted and
the best of them. Links from a word to its form rise tenfold in frequency, so
chains are short; the last form is found by doubling.

Cases: a NULL or empty text has no words; a NULL id counts as no characters in
the checksum. Repeated rows count as often as they occur. Near words that are
equally frequent are ranked by code point. An empty table gives no rows. Words
are of any length. Only the id and the text are read, so other columns may have
any name.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cdclake.llm.common import spread, stored, table

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many, by the checksum of document and run, loses a character.
DAMAGED = 31
MIN_LENGTH, MIN_COUNT = 7, 2
#: A form is so many times as frequent as the word it stands for.
RATIO = 10
#: Words of a partition that a task composes at once.
PARTITION = 20_000


def words_of_documents(docs: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the vocabulary: long runs of letters, some by rule without a character, that repeat."""
    runs = spread(docs.select("doc_id", "text")).select(
        F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("head"),
        F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= MIN_LENGTH)
    h = F.crc32(F.concat("head", "run").cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    damaged = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % DAMAGED == 0, damaged).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


# --- machines ---

class Acceptor:
    """The minimised acceptor of sorted distinct words, which numbers them in their order.

    A state's arcs are character, next state, and words that come before those
    beyond the arc; ``arc_of`` finds them by character.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[list[tuple[str, int, int]]] = []
        self.final: list[bool] = []
        self.size: list[int] = []
        known: dict[tuple, int] = {}

        def state(final: bool, out: list[tuple[str, int]]) -> int:
            number = known.setdefault((final, *out), len(self.arcs))
            if number == len(self.arcs):
                before, arcs = int(final), []
                for character, target in out:
                    arcs.append((character, target, before))
                    before += self.size[target]
                self.arcs.append(arcs)
                self.final.append(final)
                self.size.append(before)
            return number

        # The path of the last word: per state, whether it is final and its arcs but the last.
        path: list[list] = [[False, []]]
        last = ""
        for word in words:
            same = len(os.path.commonprefix([last, word]))
            while len(path) > same + 1:
                final, out = path.pop()
                path[-1][1].append((last[len(path) - 1], state(final, out)))
            path += [[False, []] for _ in word[same:]]
            path[-1][0] = True
            last = word
        while len(path) > 1:
            final, out = path.pop()
            path[-1][1].append((last[len(path) - 1], state(final, out)))
        self.start = state(*path[0])
        self.arc_of = [{character: (target, before) for character, target, before in arcs} for arcs in self.arcs]


def one_edit_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """Numbers of sorted distinct words one edit apart, each pair once; the shorter word first if lengths differ."""
    machine = Acceptor(words)
    arcs, arc_of, final = machine.arcs, machine.arc_of, machine.final

    def in_step(p: int, i: int, q: int, j: int) -> Iterator[tuple[int, int]]:
        """Words that go on alike from two states."""
        open_pairs = [(p, i, q, j)]
        while open_pairs:
            p, i, q, j = open_pairs.pop()
            if final[p] and final[q]:
                yield i, j
            other = arc_of[q]
            for character, target, before in arcs[p]:
                if character in other:
                    beyond, skipped = other[character]
                    open_pairs.append((target, i + before, beyond, j + skipped))

    # States before the edit, reached by both words alike, and the words that come before.
    open_states = [(machine.start, 0)]
    while open_states:
        q, i = open_states.pop()
        for (_, p, before), (_, r, skipped) in combinations(arcs[q], 2):
            yield from in_step(p, i + before, r, i + skipped)
        for character, r, skipped in arcs[q]:
            # The longer word has one more character here; the shorter goes on with another one, or ends.
            if final[q] and final[r]:
                yield i, i + skipped
            for going_on, p, before in arcs[q]:
                if going_on != character and going_on in arc_of[r]:
                    beyond, more = arc_of[r][going_on]
                    yield from in_step(p, i + before, beyond, i + skipped + more)
            open_states.append((r, i + skipped))


# --- partitions ---

PART = ["t", "a", "z", "head", "tail"]


def _part(word: Column, t: Column, a: Column, z: Column, n: Column) -> list[Column]:
    """A word's place in the partition of pairs whose shorter word has ``t`` characters, ``a`` first and ``z`` last ones fixed."""
    length = F.length(word)
    return [
        t.cast("int").alias("t"), a.cast("int").alias("a"), z.cast("int").alias("z"),
        F.substring(word, F.lit(1), a).alias("head"),
        F.when(z > 0, F.substring(word, length - z + 1, z)).otherwise("").alias("tail"),
        F.substring(word, a + 1, length - a - z).alias("mid"), n.alias("n"),
    ]


def first_parts(words: DataFrame) -> DataFrame:
    """Each word in its four partitions: as the shorter and as the longer word, by its beginning and by its ending."""
    length = F.length("word")
    sides = F.array(*[
        F.struct(t.alias("t"), a.alias("a"), z.alias("z"))
        for t in (length, length - 1)
        for half in (F.floor(t / 2).cast("int"),)
        for a, z in ((half, F.lit(0)), (F.lit(0), t - half))
    ])
    each = words.select("word", "n", F.explode(sides).alias("side"))
    return each.select(*_part(F.col("word"), F.col("side.t"), F.col("side.a"), F.col("side.z"), F.col("n")))


def halved(parts: DataFrame) -> DataFrame:
    """Words of large partitions in the two that each falls into: a longer beginning, or, beginnings differing, a longer ending."""
    word = F.concat("head", "mid", "tail")
    m = F.col("a") + F.floor((F.col("t") - F.col("z") - F.col("a")) / 2).cast("int")
    sides = F.array(
        F.struct(m.alias("a"), F.col("z").alias("z")), F.struct(F.col("a").alias("a"), (F.col("t") - m).alias("z"))
    )
    each = parts.select(word.alias("word"), "t", "n", F.explode(sides).alias("side"))
    return each.select(*_part(F.col("word"), F.col("t"), F.col("side.a"), F.col("side.z"), F.col("n")))


def small_parts(words: DataFrame, most: int = PARTITION) -> DataFrame:
    """All words in partitions of at most ``most`` words, which have two at least."""
    parts = stored(first_parts(words), "word-parts")
    done = []
    while True:
        sizes = parts.groupBy(*PART).agg(F.count("*").alias("words")).where("words > 1")
        # One free character more or less cannot be halved; such a partition has no more words than there are characters.
        large = stored(sizes.where((F.col("words") > most) & (F.col("t") - F.col("a") - F.col("z") > 1)).select(*PART), "large-parts")
        if large.isEmpty():
            done.append(parts)
            break
        done.append(parts.join(large, PART, "left_anti"))
        parts = stored(halved(parts.join(large, PART, "left_semi")), "word-parts")
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole


def _common_ends(words: list[str]) -> tuple[int, int]:
    """How many first and last characters all words share, without overlap in the shortest."""
    shortest = min(map(len, words))
    first = min(len(os.path.commonprefix(words)), shortest)
    last = min(len(os.path.commonprefix([w[::-1] for w in words])), shortest - first)
    return first, last


def _near_of_part(words: list[str], counts: list[int], free: int, tail: str) -> dict[int, list]:
    """Per word with near words: how many, and the frequency and number of the best. All words go on with ``tail``."""
    first, last = _common_ends(words)
    near: dict[int, list] = {}
    # Without a shared ending the order may be another one.
    core, places = zip(*sorted((w[first : len(w) - last], k) for k, w in enumerate(words)))
    for i, j in one_edit_pairs(core):
        i, j = places[i], places[j]
        # Pairs whose shorter word has another length belong elsewhere, as do, by ending, those of one beginning.
        if len(words[i]) != free or tail and words[j][:free] == words[i]:
            continue
        for x, y in ((i, j), (j, i)):
            best = near.setdefault(x, [0, 0, None])
            best[0] += 1
            if counts[y] > best[1] or counts[y] == best[1] and words[y] + tail < words[best[2]] + tail:
                best[1:] = counts[y], y
    return near


def near_words(words: DataFrame, most: int = PARTITION) -> DataFrame:
    """``word``, ``n_near`` and the best near word, ``best``, with its frequency ``best_n``, of words that have one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple | None = None
        mids: list[str] = []
        counts: list[int] = []
        out: list[tuple] = []

        def close() -> None:
            if len(mids) < 2:
                return
            t, a, z, head, tail = held
            for i, (n_near, best_n, best) in _near_of_part(mids, counts, t - a - z, tail).items():
                out.append((head + mids[i] + tail, n_near, best_n, head + mids[best] + tail))

        names = ["word", "n_near", "best_n", "best"]
        for batch in batches:
            for *part, mid, n in zip(*[batch[c] for c in PART], batch["mid"], batch["n"]):
                if part != held:
                    close()
                    held, mids, counts = part, [], []
                mids.append(mid)
                counts.append(n)
            if out:
                yield pd.DataFrame(out, columns=names)
                out = []
        if held is not None:
            close()
        if out:
            yield pd.DataFrame(out, columns=names)

    parts = small_parts(words, most).repartition(*PART).sortWithinPartitions(*PART, "mid")
    found = parts.mapInPandas(run, "word string, n_near bigint, best_n bigint, best string")
    # Of equal frequencies the word that comes first, which a minimum finds with the frequency negated.
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("first")).select(
        "word", "n_near", (-F.col("first.rank")).alias("best_n"), F.col("first.best").alias("best")
    )


# --- forms and roots ---

def roots_of(links: DataFrame, steps: int) -> DataFrame:
    """``word`` and ``root``, the end of its chain, of links with ``word`` and ``form``; no chain is longer than 2 ** ``steps``."""
    reached = links.select("word", F.col("form").alias("root"))
    for _ in range(steps):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        reached = stored(
            reached.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots"
        )
    return reached


def variants(words: DataFrame, most: int = PARTITION) -> DataFrame:
    """Per word of a vocabulary (``word`` and ``n``): ``n_near``, ``form``, ``form_n`` and ``root``."""
    words = stored(words, "vocabulary")
    near = near_words(words, most)
    is_form = F.col("best_n") >= RATIO * F.col("n")
    judged = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
    ), "judged-words")
    greatest = judged.agg(F.max("n")).first()[0] or 1
    # A chain rises tenfold a link, from 1 at least.
    longest = max(1, math.ceil(math.log(greatest, RATIO)) + 1)
    roots = roots_of(judged.where("form is not null"), math.ceil(math.log2(longest)))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = variants(words_of_documents(table(spark, sf_dir, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
