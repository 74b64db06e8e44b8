"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's subwords are the runs of two and of three characters of its lower-case
words, with a blank at either end, hashed into ``BUCKETS`` buckets. The mean of
their embeddings goes through a linear softmax. Embeddings and softmax are
trained together by stochastic gradient descent on ``TRAINING_ROWS`` labelled
rows at most. A part of those rows is kept back to fit the temperature of the
softmax and the score below which a prediction is rejected.

Cases: a NULL text, or one without a letter, is ``und`` with score 0. Ties go to
the label that sorts first. Repeated rows get equal predictions. Without
training rows every text is ``und``. Empty tables give no rows. Texts are read
whole. Only the named columns of the input are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.llm.common import spread, table

BUCKETS = 1 << 15
DIMENSIONS = 12
#: Labelled rows used for training and calibration, at most, in the order of a hash of their ids.
TRAINING_ROWS = 4000
EPOCHS = 12
BATCH = 32
RATE = 4.0
#: Share of right answers wanted among accepted predictions.
ACCEPTED_RIGHT = 0.99
#: Characters looked at together.
SLICE = 1 << 21


def letters_table() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def subwords(texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all subwords, the text each belongs to, and whether each text has a letter."""
    lower = [t.lower() if t else "" for t in texts]
    codes = np.frombuffer("\n".join(["", *lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    # Line ends inside texts must not count as ends of texts, so ends are found by length.
    owner = np.repeat(np.arange(len(lower)), np.fromiter((len(t) + 1 for t in lower), np.int64, len(lower)))
    inside = letters[codes]
    c = np.where(inside, codes, 0).astype(np.uint64)
    a, b, d = c[:-2], c[1:-1], c[2:]
    here = inside[1:-1]
    mix = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64)
    two = mix(a * np.uint64(0x1F3D5B79) + b + np.uint64(1))[here]
    three = mix((a * np.uint64(0x1F3D5B79) + b) * np.uint64(0x1F3D5B79) + d + np.uint64(2))[here]
    # Position k of the middle character is character k of the joined texts after the leading line end.
    of = owner[: len(here)][here]
    has = np.zeros(len(texts), bool)
    has[of] = True
    return np.concatenate([two, three]), np.concatenate([of, of]), has


@dataclass
class Model:
    labels: list[str]
    scores: np.ndarray  # of each bucket and label: embeddings times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    accept: float = 0.0


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_model(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model | None:
    """A model from (label, buckets, shares of the text) of each row."""
    labels = sorted({r[0] for r in rows})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = rng.normal(0, 0.1, (DIMENSIONS, len(labels))).astype(np.float32)
    bias = np.zeros(len(labels), np.float32)
    held = rows[::5] if len(rows) >= 50 else rows
    learned = [r for i, r in enumerate(rows) if i % 5] if len(rows) >= 50 else rows
    target = np.array([labels.index(r[0]) for r in learned])
    for epoch in range(EPOCHS):
        order = rng.permutation(len(learned))
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(order), BATCH):
            picked = order[at : at + BATCH]
            index = np.concatenate([learned[i][1] for i in picked])
            share = np.concatenate([learned[i][2] for i in picked]).astype(np.float32)
            sizes = np.array([len(learned[i][1]) for i in picked])
            row = np.repeat(np.arange(len(picked)), sizes)
            mean = np.zeros((len(picked), DIMENSIONS), np.float32)
            np.add.at(mean, row, embedding[index] * share[:, None])
            gap = _softmax(mean @ weights + bias)
            gap[np.arange(len(picked)), target[picked]] -= 1
            back = gap @ weights.T
            weights -= rate * mean.T @ gap / len(picked)
            bias -= rate * gap.mean(axis=0)
            np.add.at(embedding, index, -rate * share[:, None] * back[row])
    model = Model(labels, embedding @ weights, bias)
    z = np.stack([(model.scores[r[1]] * r[2][:, None]).sum(axis=0) + bias for r in held])
    truth = np.array([labels.index(r[0]) for r in held])
    loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(z)), truth] + 1e-9).mean()
    model.temperature = float(min(np.geomspace(0.5, 5, 40), key=loss))
    p = _softmax(z / model.temperature)
    best, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-best, kind="stable")
    good = np.cumsum(right[order]) >= ACCEPTED_RIGHT * np.arange(1, len(order) + 1)
    model.accept = float(best[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return model


def _slices(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The batch in parts of about ``SLICE`` characters."""
    sizes = batch["text"].str.len().fillna(0).to_numpy(dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // SLICE
    for _, rows in batch.groupby(part, sort=False):
        yield rows


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``accepted`` of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = letters_table()
        for batch in batches:
            for rows in _slices(batch):
                bucket, of, has = subwords(list(rows["text"]), letters)
                best, name = np.zeros(len(rows)), np.full(len(rows), "und", object)
                if model is not None:
                    counts = np.maximum(np.bincount(of, minlength=len(rows)), 1)
                    z = np.stack([
                        np.bincount(of, model.scores[bucket, k], len(rows)) / counts for k in range(len(model.labels))
                    ], axis=1)
                    p = _softmax((z + model.bias) / model.temperature)
                    best = np.where(has, p.max(axis=1), 0.0)
                    name = np.where(has, np.array(model.labels, object)[p.argmax(axis=1)], "und")
                yield pd.DataFrame({
                    "doc_id": rows["doc_id"].array, "lang_pred": name, "score": best,
                    "accepted": has & (best >= (model.accept if model else 1.0)),
                })

    return spread(docs.select("doc_id", "text")).mapInPandas(
        run, "doc_id bigint, lang_pred string, score double, accepted boolean"
    )


def training_rows(docs: DataFrame, limit: int = TRAINING_ROWS) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """The subword shares of at most ``limit`` labelled rows of ``docs``, ordered by a hash of the id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = letters_table()
        for batch in batches:
            for rows in _slices(batch):
                bucket, of, has = subwords(list(rows["text"]), letters)
                key, n = np.unique(of * BUCKETS + bucket, return_counts=True)
                ends = np.searchsorted(key, np.arange(len(rows) + 1) * BUCKETS)
                for i in np.flatnonzero(has):
                    a, b = ends[i], ends[i + 1]
                    yield pd.DataFrame({
                        "doc_id": [rows["doc_id"].iloc[i]], "lang": [rows["lang"].iloc[i]],
                        "buckets": [(key[a:b] % BUCKETS).astype(np.int32)], "shares": [(n[a:b] / n[a:b].sum()).astype(np.float32)],
                    })

    usable = docs.where("lang is not null and text is not null and doc_id is not null")
    picked = usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # At most ``limit`` ids, so they may be broadcast.
    rows = usable.select("doc_id", "text", "lang").join(F.broadcast(picked), "doc_id", "left_semi")
    found = rows.mapInPandas(run, "doc_id bigint, lang string, buckets array<int>, shares array<float>")
    found = found.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id")
    return [(r["lang"], np.array(r["buckets"]), np.array(r["shares"], np.float32)) for r in found.collect()]


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = train_model(training_rows(docs.where(~held_out)))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")
