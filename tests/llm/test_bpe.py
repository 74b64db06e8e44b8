"""Byte-level encoding against tiktoken, and the perfect hash on its own."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cdclake.llm import bpe
from tests.llm.cases import documents, empty

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
    found = bpe.PerfectHash(keys)
    assert sorted(found(keys).tolist()) == list(range(len(keys)))
    others = np.random.default_rng(99).integers(0, 1 << 63, 100, dtype=np.uint64)
    assert n == 0 or set(found(others).tolist()) <= set(range(len(keys)))


def test_entries_are_found_whole(plain):
    entries = bpe.Vocabulary(PATH)
    parts = [plain.decode_single_token_bytes(i) for i in range(0, 50_256, 7)]
    parts += [b"zzqqzzqq", b" qqqqzzzz", b"\xff\xfe\xfd\xfc"]
    flat, starts, ends = bpe._spans(parts)
    assert entries.whole(flat, starts, ends).tolist() == list(range(0, 50_256, 7)) + [-1, -1, -1]


def test_merges_equal_tiktoken(plain):
    entries, rng = bpe.Vocabulary(PATH), random.Random(5)
    pieces = ["".join(rng.choice("abcdefgh é漢") for _ in range(rng.randint(1, 40))).encode() for _ in range(500)]
    pieces += [b"a", b"aa" * 700, b"ab" * 999 + b"c", "x".encode() * 20_000]
    assert list(entries.merged(pieces)) == [plain._encode_single_piece(p) for p in pieces]


def test_texts_equal_tiktoken(plain):
    encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    texts = ["", " ", "\n\n \t x", "it's we'LL 'tis", "<|endoftext|>", "a​b", "́e", "1234 5６", "é ß 漢字 😀", "x" * 5000, "  two  spaces  "]
    # Every character of the first plane and some beyond, between letters, digits and signs.
    texts += [f"a{chr(c)}{chr(c)}b 1{chr(c)}!{chr(c)}" for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    texts += [f"a{chr(c)} {chr(c)}1" for c in range(0x10000, 0x20000, 37)]
    ids, counts = encoder(texts)
    ends = np.cumsum(counts)
    for text, end, count, expected in zip(texts, ends, counts, plain.encode_ordinary_batch(texts)):
        assert ids[end - count : end].tolist() == expected, text


def test_query(spark, tmp_path, plain):
    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = bpe.op11_byte_bpe(spark, str(tmp_path)).collect()
    expected = []
    for r in docs.collect():
        text = r["text"] or ""
        ids = plain.encode_ordinary(text)
        expected.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, expected))


def test_decode(spark):
    ids = spark.createDataFrame([(1, [0, 1, 2]), (2, []), (3, None)], "doc_id bigint, ids array<int>")
    found = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(ids, PATH).collect()}
    entries = {rank: entry for entry, rank in bpe.entries_of(PATH)}
    assert found == {1: entries[0] + entries[1] + entries[2], 2: b"", 3: b""}


def test_empty(spark):
    encoded = bpe.encode(empty(spark), PATH, public_tokenizers.PATTERN)
    assert bpe.decode(encoded, PATH).count() == 0


def test_remembered_merges_are_forgotten(monkeypatch, plain):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    for text in ("qwzx zxqw vbnmq plokm ijnuhb", "qwzx ygvtfc rdxesz", "wazsex qwzx"):
        assert encoder([text])[0].tolist() == plain.encode_ordinary(text)
