"""Packing documents into windows of a fixed number of tokens by Karmarkar-Karp differencing.

Each task packs its own documents, a block of tokens at a time, so nothing is
shuffled. A document is cut into whole windows and a rest. The rests of a block
are dealt to windows by multiway differencing: the two partial partitions with
the largest differences merge, heavy parts with light ones, until one is left.
Whenever a window then exceeds the capacity, the number of windows rises and the
block is dealt anew. What is still free is filled by cutting up the emptiest
windows; their last tokens go into sequences whose lengths are powers of two,
which need no padding.

Cases: a NULL or empty text is its end token alone. Repeated rows are packed as
often as they occur. An empty table gives no rows. A text of any length is
tokenized whole. Only the id and the text of the input are read.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from cdclake.llm.common import spread, table

CAPACITY = 2048
END = 1
#: Tokens packed together, about; a longer document makes a block of its own.
BLOCK = 1 << 20
#: Words whose ids a task remembers, at most.
REMEMBERED = 400_000

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


class WordTokenizer:
    """Token ids of texts, each distinct word encoded once.

    The vocabulary's splitting rule always begins a piece at a space that stands
    before another character, so a text may be cut there without changing its
    ids. ``ranks`` names the same vocabulary as ranks, which encodes short words
    sooner; words that hold a special token always take the first file. Texts
    with doubled, leading or trailing spaces are encoded whole.
    """

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.special = [t.content for t in whole.get_added_tokens_decoder().values()]
        self.encode_all = lambda words: [e.ids for e in whole.encode_batch_fast(words, add_special_tokens=False)]
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            plain = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
            )
            every = self.encode_all
            self.encode_all = lambda words: [
                every([w])[0] if any(x in w for x in self.special) else plain.encode_ordinary(w) for w in words
            ]
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.ids: list[np.ndarray] = []
        self.flat, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: set[str]) -> None:
        new = list(words - self.codes.keys())
        if not new:
            return
        first = len(self.codes)
        self.codes.update(zip(new, range(first, first + len(new))))
        found = self.encode_all(new)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), np.uint32)])
        self.lengths = np.concatenate([self.lengths, lengths])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, each followed by the end token."""
        if len(self.codes) > REMEMBERED:
            self._forget()
        parts: list[list[str]] = []
        for text in texts:
            words = text.split(" ")
            if "" in words:
                words = [text] if text else []
            else:
                words[1:] = [" " + w for w in words[1:]]
            parts.append(words)
        flat = [w for words in parts for w in words]
        self._learn(set(flat))
        codes = np.fromiter(map(self.codes.__getitem__, flat), np.int64, len(flat))
        lengths = self.lengths[codes]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[codes] - ends + lengths, lengths)
        ids = self.flat[at]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        end = np.array([END], np.uint32)
        return [np.concatenate([ids[a:b], end]) for a, b in zip(bounds[:-1], bounds[1:])]


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Items dealt to at most ``windows`` parts of near equal sums, by largest differencing.

    A partial partition is its parts' sums in falling order, empty parts left
    out, and for each part the node of a tree whose leaves are the items.
    """
    children: list[tuple[int, int] | None] = [None] * len(sizes)
    heap = [(-size, i, np.array([size]), np.array([i])) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, other, more = heapq.heappop(heap)
        # Heaviest with lightest: the first parts of each side stay alone, the last ones meet.
        alone, met = min(len(other), windows - len(sums)), max(0, len(sums) + len(other) - windows)
        merged = np.concatenate([sums, other[:alone]])
        joined = np.concatenate([nodes, more[:alone]])
        if met:
            meeting = slice(len(sums) - met, len(sums))
            merged[meeting] += other[alone:][::-1]
            created = len(children) + np.arange(met)
            children += zip(joined[meeting].tolist(), more[alone:][::-1].tolist())
            joined[meeting] = created
        rank = np.argsort(-merged, kind="stable")
        merged, joined = merged[rank], joined[rank]
        imbalance = merged[0] - (merged[-1] if len(merged) == windows else 0)
        heapq.heappush(heap, (-int(imbalance), order, merged, joined))
        order += 1
    parts = []
    for root in heap[0][3].tolist() if heap else []:
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if children[node] is None:
                found.append(node)
            else:
                stack.extend(children[node])
        parts.append(found)
    return parts


def deal(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Items of at most ``capacity`` in windows none of which exceeds it; as few as differencing allows."""
    windows = -(-sum(sizes) // capacity)
    while sizes:
        parts = difference(sizes, windows)
        most = max(sum(sizes[i] for i in part) for part in parts)
        if most <= capacity:
            return parts
        windows = max(windows + 1, windows * most // capacity)
    return []


def fill(parts: list[list[tuple]], capacity: int = CAPACITY) -> list[list[tuple]]:
    """Windows of pieces (document, start, length) made full by cutting up the emptiest of them.

    The sum divided by the capacity remain as full windows; the rest of the sum
    is cut into sequences whose lengths are powers of two.
    """
    load = lambda part: sum(p[2] for p in part)
    parts = sorted(parts, key=load, reverse=True)
    whole = sum(map(load, parts)) // capacity
    full, loose = parts[:whole], [p for part in parts[whole:] for p in part]

    def take(n: int) -> list[tuple]:
        taken = []
        while n:
            doc, start, length = loose.pop()
            taken.append((doc, start, min(n, length)))
            if length > n:
                loose.append((doc, start + n, length - n))
            n -= min(n, length)
        return taken

    for part in full:
        part.extend(take(capacity - load(part)))
    rest = load(loose)
    return full + [take(1 << bit) for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]


def _pack_block(ids: list[np.ndarray], capacity: int) -> list[list[tuple]]:
    sequences, rests = [], []
    for doc, tokens in enumerate(ids):
        cut = len(tokens) - len(tokens) % capacity
        sequences += [[(doc, at, capacity)] for at in range(0, cut, capacity)]
        if cut < len(tokens):
            rests.append((doc, cut, len(tokens) - cut))
    parts = deal([r[2] for r in rests], capacity)
    return sequences + fill([[rests[i] for i in part] for part in parts], capacity)


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of a document: where it comes from, and its sequence and offset there."""

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = WordTokenizer(tokenizer, ranks)
        next_id = TaskContext.get().partitionId() << 40
        names: list = []
        ids: list[np.ndarray] = []

        def rows() -> pd.DataFrame:
            nonlocal next_id
            found = []
            for sequence in _pack_block(ids, capacity):
                offset = 0
                for doc, start, length in sequence:
                    crc = zlib.crc32(ids[doc][start : start + length].astype("<u4").tobytes())
                    found.append((names[doc], start, length, crc, len(ids[doc]), next_id, offset))
                    offset += length
                next_id += 1
            names.clear()
            ids.clear()
            frame = pd.DataFrame(found, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            return frame.astype({"doc_id": "Int64"})

        held = 0
        for batch in batches:
            for name, text in zip(batch["doc_id"], batch["text"]):
                names.append(None if pd.isna(name) else int(name))
                ids.append(text or "")
                held += len(ids[-1]) // 3 + 1
                if held >= BLOCK:
                    ids[:] = encode(ids)
                    yield rows()
                    held = 0
        if ids:
            ids[:] = encode(ids)
            yield rows()

    return spread(docs.select("doc_id", "text")).mapInPandas(packed, SCHEMA)


def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return pack(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))
