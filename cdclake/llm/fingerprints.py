"""Document fingerprints by a randomised edit embedding.

All texts are walked with the same random bits: at each step the walk writes the
character it stands on and moves on if the bit of that step and character is
set. Texts a few edits apart fall into step again soon after each edit, so their
walks differ in few steps. A fingerprint keeps the characters written at sampled
steps. The steps of a coarser sample are among those of a finer one, so texts of
any two lengths can be compared. Likeness is the share of common sampled steps
that agree, of all that either text reaches.

Similar fingerprints are found by bands: some sampled steps each, hashed; those
that meet in a band are verified by their likeness.

Cases: a NULL or empty text has the fingerprint ``0:``; two empty texts are alike
(1), an empty one and another are not (0). Rows are ordered by id, a NULL id
first, then by text. A single row is its own next. Repeated rows follow each
other. Empty tables give no rows. Texts are walked whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.llm.common import stored, table
from cdclake.llm.hashing import mix

PERIOD = 1024
#: A fingerprint samples between this many steps and twice as many, unless the text is shorter.
SAMPLES = 128
#: Characters walked together; a longer text is walked alone.
SLICE = 1 << 21
SYMBOLS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_", np.uint8)
BANDS = 24
BAND_STEPS = 8
ALIKE = 0.8


def _dwell() -> np.ndarray:
    """For each class of characters and step, how many steps the walk stays."""
    grid = np.arange(256 * PERIOD, dtype=np.uint64).reshape(256, PERIOD)
    bits = (mix(grid + np.uint64(1 << 40)) & np.uint64(1)).astype(bool)
    stay = np.zeros((256, PERIOD), np.int32)
    ahead = np.full(256, PERIOD, np.int32)
    for step in [*reversed(range(PERIOD))] * 2:
        ahead = np.where(bits[:, step], 1, ahead + 1)
        stay[:, step] = ahead
    return stay.ravel()


def sampled_steps(level: int, end: int) -> np.ndarray:
    """The steps below ``end`` that a sample of this level has: one in 2 ** level, by hash."""
    steps = np.arange(end, dtype=np.uint64)
    return steps[mix(steps + np.uint64(77)) & np.uint64((1 << level) - 1) == 0].astype(np.int64)


def level_of(length: int) -> int:
    """The level at which a text of this many characters, walked in about twice as many steps, is sampled."""
    return max(0, (2 * length // SAMPLES).bit_length() - 1)


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprint of every text: level, colon, sampled symbols in the order of their steps."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    codes = np.frombuffer("".join(texts[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)
    scrambled = mix(codes.astype(np.uint64))
    kind = (scrambled >> np.uint64(8) & np.uint64(255)).astype(np.int32) * PERIOD
    symbol = (scrambled & np.uint64(63)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    stay = _dwell()
    begun = np.empty(len(codes), np.int32)
    at, time = starts.copy(), np.zeros(len(sizes), np.int32)
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right").tolist()
    for a in active:
        place, now = at[:a], time[:a]
        begun[place] = now
        now += stay[kind[place] + (now & (PERIOD - 1))]
        place += 1
    longest = int(time.max()) if len(time) else 0
    samples = {k: sampled_steps(k, longest) for k in {level_of(int(n)) for n in sizes}}
    found = [""] * len(texts)
    for rank, i in enumerate(order):
        level, a, n = level_of(int(sizes[rank])), starts[rank], sizes[rank]
        steps = samples[level]
        steps = steps[: np.searchsorted(steps, time[rank])]
        standing = np.searchsorted(begun[a : a + n], steps, "right") - 1
        found[i] = f"{level}:{SYMBOLS[symbol[a + standing]].tobytes().decode()}" if n else "0:"
    return found


def _coarser(fingerprint: str, level: int) -> str:
    """The symbols of a fingerprint at a coarser level."""
    own, symbols = fingerprint.split(":", 1)
    if int(own) == level:
        return symbols
    end = 1024
    while len(steps := sampled_steps(int(own), end)) < len(symbols):
        end *= 2
    keep = mix(steps[: len(symbols)].astype(np.uint64) + np.uint64(77)) & np.uint64((1 << level) - 1) == 0
    return np.frombuffer(symbols.encode(), np.uint8)[keep].tobytes().decode()


def likeness(a: str, b: str) -> float:
    """The share of sampled steps at which two fingerprints agree, of those either reaches."""
    if a == b:
        return 1.0
    level = max(int(a.split(":", 1)[0]), int(b.split(":", 1)[0]))
    x, y = (np.frombuffer(_coarser(f, level).encode(), np.uint8) for f in (a, b))
    both, most = min(len(x), len(y)), max(len(x), len(y))
    return float((x[:both] == y[:both]).sum() / most) if most else 0.0


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(ids: list, texts: list[str], following: list[str]) -> pd.DataFrame:
    """The result rows of texts and of the texts that follow them."""
    rows = []
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) + len(following[last]) < SLICE):
            size += len(texts[last]) + len(following[last])
            last += 1
        own, others = texts[first:last], following[first:last]
        edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(own, others)]
        # A text that follows is, all but once, the next text itself.
        shifted = own[1:] + others[-1:]
        extra = [k for k, (a, b) in enumerate(zip(shifted, others)) if a is not b and a != b]
        prints = fingerprints(own + edited + others[-1:] + [others[k] for k in extra])
        mine, theirs = prints[: len(own)], prints[len(own) : 2 * len(own)]
        nexts = mine[1:] + prints[2 * len(own) : 2 * len(own) + 1]
        for k, p in zip(extra, prints[2 * len(own) + 1 :]):
            nexts[k] = p
        rows += [
            (ids[first + k], len(own[k]), hashlib.sha256(edited[k].encode("utf-8", "surrogatepass")).hexdigest(), mine[k],
             theirs[k], likeness(mine[k], theirs[k]), likeness(mine[k], nexts[k]))
            for k in range(len(own))
        ]
        first = last
    return pd.DataFrame(rows, columns=COLUMNS).astype({"doc_id": "Int64"})


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, that of its text edited with the next one's, and the likenesses.

    Rows are dealt to tasks by ranges of their ids, one shuffle. A task sees the
    next row of all its rows but the last; it hands on its first and last text,
    and those are paired in a second step of two rows a task. The driver gets
    the numbers of the tasks that had rows.
    """
    ids = lambda column: [None if pd.isna(v) else int(v) for v in column]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        held = None
        edge = lambda kind, row: pd.DataFrame([row], columns=["doc_id", "text"]).astype(
            {"doc_id": "Int64"}).assign(kind=kind, task=task)
        for batch in batches:
            rows = list(zip(ids(batch["doc_id"]), (t or "" for t in batch["text"])))
            if not rows:
                continue
            if held is None:
                yield edge("first", rows[0])
            else:
                rows.insert(0, held)
            held = rows[-1]
            done = _compared([r[0] for r in rows[:-1]], [r[1] for r in rows[:-1]], [r[1] for r in rows[1:]])
            yield done.assign(kind="done", task=task)
        if held is not None:
            yield edge("last", held)

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _compared(ids(batch["doc_id"]), list(batch["text"]), list(batch["next"]))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in run(batches):
            parts = {c: list(frame[c]) if c in frame else [None] * len(frame) for c in ["kind", "task", "text", *COLUMNS]}
            yield pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in parts.items()}).astype(
                {"task": "int64", "doc_id": "Int64", "n_chars": "Int64", "near_edited": "float64", "near_next": "float64"})

    spark = docs.sparkSession
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    found = stored(ordered.mapInPandas(whole, f"kind string, task bigint, text string, {RESULT}"), "neighbours")
    tasks = [r["task"] for r in found.where("kind = 'first'").select("task").orderBy("task").collect()]
    follows = spark.createDataFrame(list(zip(tasks, tasks[1:] + tasks[:1])), "task bigint, after bigint")
    last = found.where("kind = 'last'").select("task", "doc_id", "text").join(follows, "task")
    first = found.where("kind = 'first'").select(F.col("task").alias("after"), F.col("text").alias("next"))
    joined = last.join(first, "after").select("doc_id", "text", "next").mapInPandas(ends, RESULT)
    return found.where("kind = 'done'").select(*COLUMNS).unionByName(joined)


def bands(prints: DataFrame) -> DataFrame:
    """The band keys of rows with ``fingerprint``, at its level and at the next coarser one."""
    picks = [np.sort(np.random.default_rng(k).choice(SAMPLES // 2, BAND_STEPS, replace=False)) for k in range(BANDS)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for p in batch["fingerprint"]:
                for level in (int(p.split(":", 1)[0]), int(p.split(":", 1)[0]) + 1):
                    symbols = _coarser(p, level)
                    rows += [(p, f"{level}.{k}." + "".join(symbols[i : i + 1] for i in pick)) for k, pick in enumerate(picks)]
            yield pd.DataFrame(rows, columns=["fingerprint", "band"])

    return prints.select("fingerprint").distinct().mapInPandas(run, "fingerprint string, band string")


def similar_fingerprints(prints: DataFrame, alike: float = ALIKE) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints with their ``likeness``, at least ``alike``.

    A band gives pairs with its least fingerprint alone, so a band that very many
    share makes no more pairs than rows; over all bands the pairs join what the
    bands bring together. Bands are random: a likeness of 0.8 meets in one of
    them with probability 0.98, one of 0.9 almost surely.
    """
    banded = stored(bands(prints), "bands")
    least = banded.groupBy("band").agg(F.min("fingerprint").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = banded.join(least, "band").where("fingerprint <> b").select(F.col("fingerprint").alias("a"), "b").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = batch.assign(likeness=[likeness(a, b) for a, b in zip(batch["a"], batch["b"])])
            yield found[found["likeness"] >= alike]

    return pairs.mapInPandas(run, "a string, b string, likeness double")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_neighbours(table(spark, sf_dir, "documents"))
