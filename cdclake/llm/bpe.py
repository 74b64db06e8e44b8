"""Byte-level byte-pair encoding and decoding with the ranks of a given vocabulary.

A text is cut into pre-tokens by the vocabulary's pattern; each is encoded by
itself. Two tiers. First a minimal perfect hash over the vocabulary: all new
pre-tokens of a slice of text are hashed at once, each hash points at the one
entry that could be equal, and their bytes are compared, so a pre-token that is
an entry takes its rank. The others are merged: their bytes form a linked list,
a heap holds the neighbouring pairs that are entries, by rank and place, and the
pair of least rank is joined until no pair is an entry. A task remembers the
pre-tokens it has met, up to a bound.

The hash maps a key to three vertices of a sparse hypergraph; edges are peeled
off vertices that have no other one, and each edge is then given the vertex it
was peeled from by one number per vertex.

Cases: a NULL or empty text has no ids and decodes to no bytes. Repeated rows
are encoded alike. An empty table gives no rows. Texts of any length are encoded
whole. Only the id and the text are read, so other columns may have any name.
A NULL list of ids decodes to no bytes; an id the vocabulary lacks is an error.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.llm.common import spread, table
from cdclake.llm.hashing import mix, prefix_hashes, span_hashes

#: Characters of text encoded together; a longer text is encoded alone.
SLICE = 1 << 20
#: Pre-tokens a task remembers, at most, beside those of one slice.
REMEMBERED = 600_000
#: Characters of pre-tokens merged over one linked list; a longer pre-token has its own.
CHUNK = 1 << 13
#: Vertices per key of the hypergraph; it can be peeled above 1.22.
SPARE = 1.3


class PerfectHash:
    """A minimal perfect hash: ``n`` distinct 64-bit values to the numbers below ``n``."""

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        self.third = int(self.n * SPARE / 3) + 2
        self.seed = 0
        while True:
            nodes = self._nodes(keys)
            order = self._peel(nodes)
            if order is not None:
                break
            self.seed += 1
        total = 3 * self.third
        self.value = np.zeros(total, np.int8)
        taken = np.zeros(total, bool)
        for edges, free in reversed(order):
            # The free vertex of an edge is in no edge peeled later, so all others have their value already.
            place = free // self.third
            others = self.value[nodes[edges]].sum(axis=1, dtype=np.int64) - self.value[free]
            self.value[free] = (place - others) % 3
            taken[free] = True
        self.rank = (np.cumsum(taken) - taken).astype(np.int32)

    def _nodes(self, keys: np.ndarray) -> np.ndarray:
        parts = [mix(keys + np.uint64(0x9E37 * (3 * self.seed + k + 1))) for k in range(3)]
        return np.stack([
            (x >> np.uint64(32)).astype(np.int64) * self.third >> 32 for x in parts
        ], axis=1) + np.arange(3) * self.third

    def _peel(self, nodes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Edges and the vertex each is peeled from, round by round; None if a core is left."""
        degree = np.bincount(nodes.ravel(), minlength=3 * self.third)
        edges_at = np.zeros(3 * self.third, np.int64)
        for k in range(3):
            np.bitwise_xor.at(edges_at, nodes[:, k], np.arange(len(nodes)))
        order, left = [], len(nodes)
        while left:
            free = np.flatnonzero(degree == 1)
            if not len(free):
                return None
            edges, first = np.unique(edges_at[free], return_index=True)
            order.append((edges, free[first]))
            left -= len(edges)
            for k in range(3):
                np.subtract.at(degree, nodes[edges, k], 1)
                np.bitwise_xor.at(edges_at, nodes[edges, k], edges)
        return order

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; a value that is no key gets the number of some key."""
        nodes = self._nodes(keys)
        pick = self.value[nodes].sum(axis=1, dtype=np.int64) % 3
        return np.minimum(self.rank[nodes[np.arange(len(keys)), pick]], max(self.n - 1, 0))


def entries_of(path: str) -> list[tuple[bytes, int]]:
    """The entries of a rank file and their ranks."""
    with open(path, "rb") as lines:
        return [(base64.b64decode(a), int(b)) for a, b in map(bytes.split, lines)]


class Vocabulary:
    """The entries of a rank file, found by whole bytes through a perfect hash."""

    def __init__(self, path: str):
        pairs = entries_of(path)
        ranks = dict(pairs)
        #: The rank of each byte, and of every two entries that together are an entry, by both ranks.
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.joined = {
            ranks[entry[:k]] << 32 | ranks[entry[k:]]: rank
            for entry, rank in pairs for k in range(1, len(entry)) if entry[:k] in ranks and entry[k:] in ranks
        }
        self.two = np.full((256, 256), -1, np.int64)
        for entry, rank in pairs:
            if len(entry) == 2:
                self.two[entry[0], entry[1]] = rank
        flat, starts, ends = _spans([entry for entry, _ in pairs])
        hashes = span_hashes(prefix_hashes(flat), starts, ends)
        if len(np.unique(hashes)) < len(pairs):
            raise ValueError(f"two entries of {path} have one hash")
        self.hash = PerfectHash(hashes)
        slot = self.hash(hashes)
        self.flat = flat
        self.start, self.length, self.rank = (np.zeros(len(pairs), np.int64) for _ in range(3))
        self.start[slot], self.length[slot], self.rank[slot] = starts, ends - starts, [rank for _, rank in pairs]

    def whole(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The rank of each span of bytes that is an entry, else -1. Compares the bytes, not the hashes alone."""
        slot = self.hash(span_hashes(prefix_hashes(codes), starts, ends))
        length = ends - starts
        found = np.flatnonzero(self.length[slot] == length)
        size = length[found]
        step = _runs(size)
        same = codes[np.repeat(starts[found], size) + step] == self.flat[np.repeat(self.start[slot[found]], size) + step]
        wrong = np.zeros(len(found), bool)
        wrong[np.repeat(np.arange(len(found)), size)[~same]] = True
        rank = np.full(len(starts), -1, np.int64)
        rank[found[~wrong]] = self.rank[slot[found[~wrong]]]
        return rank

    def merged(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """The ranks of each piece's parts after all merges: a heap of pairs over a linked list of its bytes.

        The lists run over the bytes of all pieces. ``ahead`` and ``behind`` hold
        where the next and the last part begin, ``part`` the rank of the part that
        begins there, ``pair`` that of the part joined with the next one, by which
        stale heap entries are told.
        """
        codes, _, ends = _spans(pieces)
        part = self.byte_rank[codes].tolist()
        first = np.append(self.two[codes[:-1], codes[1:]], -1) if len(codes) else np.zeros(0, np.int64)
        first[ends - 1] = -1
        shift, mask = len(codes).bit_length(), (1 << len(codes).bit_length()) - 1
        pair, heaped = first.tolist(), np.where(first >= 0, first << shift | np.arange(len(first)), -1).tolist()
        ahead, behind = list(range(1, len(codes) + 1)), list(range(-1, len(codes)))
        rank_of, pop, push = self.joined.get, heapq.heappop, heapq.heappush
        begin = 0
        for end in ends.tolist():
            heap = [x for x in heaped[begin:end] if x >= 0]
            heapq.heapify(heap)
            while heap:
                least = pop(heap)
                left, rank = least & mask, least >> shift
                if pair[left] != rank:
                    continue
                right = ahead[left]
                stop = ahead[left] = ahead[right]
                part[left], pair[left], pair[right] = rank, -1, -1
                if stop < end:
                    behind[stop] = left
                    new = rank_of(rank << 32 | part[stop])
                    if new is not None:
                        pair[left] = new
                        push(heap, new << shift | left)
                if left > begin:
                    before = behind[left]
                    new = rank_of(part[before] << 32 | rank)
                    if new is None:
                        pair[before] = -1
                    else:
                        pair[before] = new
                        push(heap, new << shift | before)
            found = []
            while begin < end:
                found.append(part[begin])
                begin = ahead[begin]
            yield found


def _spans(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    return np.frombuffer(b"".join(parts), np.uint8), ends - np.diff(ends, prepend=0), ends


class _Known(dict):
    """Numbers of pre-tokens met before; new ones are numbered first and resolved together by ``settle``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.flat, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number

    def settle(self, vocabulary: Vocabulary) -> None:
        pieces = [x.encode("utf-8", "surrogatepass") for x in self.new]
        ranks = vocabulary.whole(*_spans(pieces))
        missed = [pieces[k] for k in np.flatnonzero(ranks < 0)]
        merged = [ids for some in _sliced(missed, CHUNK) for ids in vocabulary.merged(some)]
        lengths = np.ones(len(pieces), np.int64)
        lengths[ranks < 0] = np.fromiter(map(len, merged), np.int64, len(merged))
        flat = np.repeat(ranks, lengths)
        flat[flat < 0] = np.fromiter(chain.from_iterable(merged), np.int64)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.new = []


def _runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each length, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


class Encoder:
    """Ids of texts; a task keeps one, and with it what it has merged."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocabulary, self.find = Vocabulary(path), regex.compile(pattern).findall
        self.known = _Known()

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and how many each text has."""
        if len(self.known) > REMEMBERED:
            self.known = _Known()
        found = [self.find(text) for text in texts]
        pieces = np.fromiter(map(len, found), np.int64, len(found))
        numbers = np.fromiter(map(self.known.__getitem__, chain.from_iterable(found)), np.int64, int(pieces.sum()))
        self.known.settle(self.vocabulary)
        lengths = self.known.lengths[numbers]
        ids = self.known.flat[np.repeat(self.known.starts[numbers], lengths) + _runs(lengths)]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(upto[np.concatenate([[0], np.cumsum(pieces)])])


def _sliced(texts: list[str], limit: int = SLICE) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids``, the ranks of the text's parts in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            at = 0
            for texts in _sliced([t or "" for t in batch.column("text").to_pylist()]):
                ids, counts = encoder(texts)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), lists], ["doc_id", "ids"])
                at += len(texts)

    return spread(docs.select("doc_id", "text")).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` rows, ``doc_id`` and ``ids``, with ``decoded``, the bytes their ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = {rank: entry for entry, rank in entries_of(path)}.__getitem__
        for batch in batches:
            ids = batch.column("ids")
            # A row at a time: the ids of a whole batch as Python numbers would take many times its size.
            decoded = [b"".join(map(entry, x.values.to_numpy().tolist())) if x.is_valid else b"" for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, decoded binary")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN, path

    ranks = path("byte_bpe_50k.tiktoken")
    decoded = decode(encode(table(spark, sf_dir, "documents"), ranks, PATTERN), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
