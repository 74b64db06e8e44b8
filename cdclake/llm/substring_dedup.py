"""Removal of every byte covered by a string of ``LEAST`` bytes that starts at two places or more.

Meeting. Of every window of ``LEAST - GRAM + 1`` hashed byte groups the least is
the anchor (the last of equals), so equal strings of ``LEAST`` bytes have the same
anchor at the same distance. The windows of one anchor, with the bytes they
cover, are its context; each window lies in one context alone. Contexts whose
anchors have equal bytes meet; equal contexts are counted once, and one that
occurs twice is repeated as a whole.

Marking. The different contexts that meet are put into a run-length index (see
``run_index``) whose matching statistics give the repeated strings among them.

Very common anchors. If the contexts that meet are more than ``HOT`` bytes, each
is cut into spans of fewer windows, which meet by all the bytes that the windows
of a span have in common, and so on down to single windows, which are equal or
not. So no task holds all contexts of a very common passage, and none is left out.

Equal texts are looked at once. If there are two or more, of ``LEAST`` bytes or
more, all is removed.

Cases: a NULL text is empty. Texts shorter than ``LEAST`` keep all. Repeated rows
are copies like others. Rows keep their id, which may be NULL or not unique.
Empty tables give no rows. Texts are read whole, as UTF-8 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.llm.common import spread, stored, table
from cdclake.llm.hashing import mix, prefix_hashes, slices, span_hashes
from cdclake.llm.run_index import repeated_bytes

LEAST = 400
GRAM = 50
#: Bytes of contexts put into one index together, about.
CHUNK = 1 << 19
#: Bytes of contexts under one key from which they are cut into narrower spans.
HOT = 1 << 21
#: Windows of a span, by level; the last is one window.
NARROWER = (64, 8, 1)

ANCHORS = "fp bigint, at int, low int, high int"


def anchors(data: bytes, least: int = LEAST, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Hash, place, and first and last window of every anchor of a text of ``least`` bytes or more."""
    codes = np.frombuffer(data, np.uint8)
    starts = np.arange(len(codes) - gram + 1)
    h = span_hashes(prefix_hashes(codes), starts, starts + gram)
    width = least - gram + 1
    n = len(h)
    # Least hash of each window, from running minima of blocks in both directions.
    padded = np.concatenate([h, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least_of = np.minimum(backward[: n - width + 1], forward[width - 1 : n])
    windows = len(least_of)
    place = np.flatnonzero(_is_window_least(h, least_of, width))
    value = h[place]
    low, high = np.maximum(place - width + 1, 0), np.minimum(place, windows - 1)
    # Narrowed by smaller hashes before, and by smaller or equal ones after.
    step, near = 1, True
    while step < len(place) and near:
        a, b = place[:-step], place[step:]
        close = b - a < width
        low[step:] = np.where(close & (value[:-step] < value[step:]), np.maximum(low[step:], a + 1), low[step:])
        high[:-step] = np.where(close & (value[step:] <= value[:-step]), np.minimum(high[:-step], b - width), high[:-step])
        step, near = step + 1, close.any()
    good = low <= high
    return value[good].view(np.int64), place[good], low[good], high[good]


def _is_window_least(h: np.ndarray, least_of: np.ndarray, width: int) -> np.ndarray:
    """Whether a place has the least hash of a window it lies in: the greatest of those windows' least is its own."""
    n = len(h)
    low = np.zeros(width - 1, np.uint64)
    line = np.concatenate([low, least_of, low])
    padded = np.concatenate([line, np.zeros(-len(line) % width, np.uint64)]).reshape(-1, width)
    forward = np.maximum.accumulate(padded, axis=1).ravel()
    backward = np.maximum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.maximum(backward[:n], forward[width - 1 : width - 1 + n]) == h


def _anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in slices(batches):
        out = {"digest": [], "fp": [], "at": [], "low": [], "high": []}
        for digest, text in zip(rows["digest"], rows["text"]):
            data = text.encode("utf-8", "surrogatepass")
            if len(data) >= LEAST:
                found = anchors(data)
                out["digest"].append(np.full(len(found[0]), digest, object))
                for name, values in zip(("fp", "at", "low", "high"), found):
                    out[name].append(values)
        if out["fp"]:
            yield pd.DataFrame({k: np.concatenate(v) for k, v in out.items()})


def _cut(data: bytes, at: int, low: int, high: int, level: int) -> Iterator[tuple[int, int, int]]:
    """The first and last windows of each span of a context at a level, and the hash of what they share."""
    width = NARROWER[level]
    base = at - (LEAST - GRAM)
    for span in range((low - base) // width, (high - base) // width + 1):
        start, end = base + span * width, base + (span + 1) * width - 1
        core = data[end : start + LEAST]
        key = hashlib.blake2b(core, digest_size=8, salt=f"{level}.{span}".encode()).digest()
        yield max(low, start), min(high, end), int.from_bytes(key, "little", signed=True)


#: ``bytes`` is NULL where the context occurs in its text before; ``n`` is then 0, and 2 at the first such place.
CONTEXT = "key bigint, rel int, hash bigint, digest string, at int, low int, high int, n int, bytes binary"


def _context(key: int, data: bytes, digest: str, at: int, low: int, high: int) -> tuple:
    body = data[low : high + LEAST]
    h = int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)
    return key, low - at, h, digest, at, low, high, 1, body


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The contexts of each text's anchors in ``found``."""
    for rows in slices(batches):
        out = []
        for digest, text, found in zip(rows["digest"], rows["text"], rows["found"]):
            data = text.encode("utf-8", "surrogatepass")
            seen: dict[tuple, int] = {}
            for a in found:
                row = _context(a["fp"], data, digest, a["at"], a["low"], a["high"])
                first = seen.setdefault(row[:3], len(out))
                if first < len(out):
                    out[first] = out[first][:7] + (2, out[first][8])
                    row = row[:7] + (0, None)
                out.append(row)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in CONTEXT.split(", ")])


def _narrowed(level: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                shift = r.low
                for low, high, key in _cut(r.bytes, r.at - shift, 0, r.high - shift, level):
                    out.append(_context(key, r.bytes, r.digest, r.at - shift, low, high)[:4] + (r.at, low + shift, high + shift, r.n, r.bytes[low : high + LEAST]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in CONTEXT.split(", ")])

    return run


MARKED = "key bigint, rel int, hash bigint, hot boolean, spans array<struct<a:int,b:int>>"


def _marked(can_narrow: bool):
    """Of rows (key, rel, hash, n, bytes) sorted by key, the repeated spans of each context."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["key", "rel", "hash", "hot", "spans"]
        group: list[tuple] = []
        key, size, hot = None, 0, False
        pending: list[tuple] = []
        pending_size = 0
        out: list[tuple] = []
        whole = lambda body: [{"a": 0, "b": len(body)}]

        def close() -> None:
            nonlocal group, size, pending_size
            if hot:
                return
            if len(group) == 1:
                _, rel, h, n, body = group[0]
                if n > 1:
                    out.append((key, rel, h, False, whole(body)))
            else:
                pending.extend(group)
                pending_size += size

        def index() -> None:
            nonlocal pending, pending_size
            if pending:
                spans = repeated_bytes([p[4] for p in pending], LEAST)
                for (k, rel, h, n, body), found in zip(pending, spans):
                    if n > 1 or found:
                        out.append((k, rel, h, False, whole(body) if n > 1 else [{"a": a, "b": b} for a, b in found]))
            pending, pending_size = [], 0

        for batch in batches:
            for row in zip(batch["key"], batch["rel"], batch["hash"], batch["n"], batch["bytes"]):
                if row[0] != key:
                    close()
                    if pending_size >= CHUNK:
                        index()
                    group, key, size, hot = [], row[0], 0, False
                if not hot:
                    group.append(row)
                    size += len(row[4])
                    if can_narrow and size > HOT:
                        hot = True
                        out.append((key, 0, 0, True, []))
                        group = []
            if out:
                yield pd.DataFrame(out, columns=names)
                out = []
        close()
        index()
        if out:
            yield pd.DataFrame(out, columns=names)

    return run


def removed_spans(docs: DataFrame) -> DataFrame:
    """``digest`` (of a text) and the removed spans ``a`` to ``b`` of its bytes, found between different texts and within one.

    ``docs`` have ``text`` and ``digest``, equal texts at most a few times.
    """
    found = stored(spread(docs.select("digest", "text")).mapInPandas(_anchored, f"digest string, {ANCHORS}"), "anchors")
    # Stored, so that both sides of the join are dealt anew and a very common anchor's rows can be split.
    common = stored(found.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "common-anchors")
    met = found.join(common, "fp").groupBy("digest").agg(F.collect_set(F.struct("fp", "at", "low", "high")).alias("found"))
    texts = docs.select("digest", "text").join(met, "digest").dropDuplicates(["digest"])
    contexts = stored(texts.mapInPandas(_contexts, CONTEXT), "contexts")
    # Places that repeat inside their own text are removed whole.
    whole = contexts.where("bytes is null").select("digest", F.col("low").alias("a"), (F.col("high") + LEAST).alias("b"))
    spans = whole.union(contexts.where("n = 2").select("digest", "low", F.col("high") + LEAST))
    contexts = contexts.where("bytes is not null")
    for level in range(len(NARROWER) + 1):
        different = contexts.groupBy("key", "rel", "hash").agg(F.sum("n").alias("n"), F.first("bytes").alias("bytes"))
        sorted_ = different.repartition("key").sortWithinPartitions("key", "rel", "hash")
        marked = stored(
            sorted_.select("key", "rel", "hash", "n", "bytes").mapInPandas(_marked(level < len(NARROWER)), MARKED), "marked"
        )
        places = contexts.drop("bytes").join(marked.where("not hot"), ["key", "rel", "hash"])
        one = places.select("digest", F.col("low").alias("shift"), F.inline("spans")).select(
            "digest", (F.col("a") + F.col("shift")).alias("a"), (F.col("b") + F.col("shift")).alias("b")
        )
        spans = spans.union(one)
        hot = marked.where("hot").select("key")
        if level == len(NARROWER) or hot.isEmpty():
            break
        narrow = contexts.join(hot, "key").select(*[c.split()[0] for c in CONTEXT.split(", ")])
        contexts = stored(narrow.mapInPandas(_narrowed(level), CONTEXT), "narrowed")
    return spans


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.md5(text).alias("digest"))
    copies = stored(rows.groupBy("digest").agg(F.count("*").alias("copies")), "copies")
    spans = removed_spans(rows).groupBy("digest").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    gone = copies.join(spans, "digest", "left").where("copies > 1 or spans is not null")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, body, copies_, spans_ in zip(batch["doc_id"], batch["text"], batch["copies"], batch["spans"]):
                data = body.encode("utf-8", "surrogatepass")
                found = [(s["a"], s["b"]) for s in spans_] if spans_ is not None else []
                if copies_ > 1 and len(data) >= LEAST:
                    found = [(0, len(data))]
                kept, at, removed, n = [], 0, 0, 0
                for a, b in sorted(found):
                    if a > at or n == 0:
                        kept.append(data[at:a])
                        n += 1
                        removed += b - a
                    else:
                        removed += max(0, b - at)
                    at = max(at, b)
                kept.append(data[at:])
                out.append((doc_id, len(data), removed, n, b"".join(kept)))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
            yield frame.astype({"doc_id": "Int64"})

    joined = rows.join(gone, "digest", "left").select("doc_id", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "spans")
    return joined.mapInPandas(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
