"""Personal data: voting labelers, their reliabilities by expectation-maximisation, and a span classifier.

Candidates are the spans of four strict patterns (the base kinds) and of looser
patterns for secrets and for numbers in other writings. Labelers vote on each
candidate: patterns, gazetteers of words and of domains, and the words around
it. Equal vote rows are counted in Spark, so the driver sees distinct vote rows
alone, at most 3 ** (number of labelers). Expectation-maximisation estimates how
reliable each labeler is; the resulting probabilities train a logistic
regression on hashed span features, fitted on ``TRAINING_SPANS`` candidates at
most and applied to every candidate. Base spans are always kept.

Cases: a NULL or empty text has no spans. Repeated rows get equal rows. Empty
tables give no rows. A text of any length is read whole, in time linear in its
length. Only the id and the text of the input are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.llm.common import spread, stored, table

#: Candidates the classifier is fitted on, at most, in the order of a hash.
TRAINING_SPANS = 20_000
FEATURES = 1 << 12
#: Probability from which a candidate beyond the base kinds is kept.
KEEP = 0.5
PRIOR_VOTES = 20
BASE = ["email", "ip", "card", "phone"]

# A base match cannot begin inside a run that an earlier start has failed on, so runs are entered at
# their first character and never given back; that keeps the search linear.
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/-])(?:[A-Za-z0-9_+/-]){20,}+")
_NUMBER = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[ ./-][0-9]{2,4}(?:[ ./-][0-9]{2,6}){1,3}(?![0-9A-Za-z])")

#: Words that announce personal data, and words that announce other numbers.
SECRET_WORDS = frozenset("token secret password passwd pwd key apikey api_key access_key auth bearer credential".split())
CONTACT_WORDS = frozenset("phone tel telephone mobile cell fax call contact ssn passport iban account".split())
PLAIN_WORDS = frozenset("version page pages section chapter isbn issn doi sha256 md5 commit http https license".split())
MAIL_DOMAINS = frozenset("com org net edu gov io de fr es info".split())

LABELERS = ["pattern", "checked", "gazetteer", "announced", "plain", "mixed", "quoted", "long"]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            last = m.end()


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base kinds, by start and then kind."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(a, BASE[k], b) for a, k, b in sorted(found)]


def candidates(text: str) -> list[tuple[int, str, int]]:
    """Base spans, and possible secrets and numbers that overlap none of them."""
    base = base_spans(text)
    taken = [(a, b) for a, _, b in base]
    more = [(m.start(), "secret", m.end()) for m in _SECRET.finditer(text)]
    more += [(m.start(), "number", m.end()) for m in _NUMBER.finditer(text)]
    more += [(m.start(), "number", m.end()) for m in _CARD.finditer(text) if m.end() - m.start() >= 9]
    kept, at, last = [], 0, -1
    for a, kind, b in sorted(more):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if a < last or (at < len(taken) and taken[at][0] < b):
            continue
        kept.append((a, kind, b))
        last = b
    return sorted(base + kept)


def context(text: str, start: int) -> list[str]:
    """The words just before a span, nearest first."""
    return re.findall(r"[A-Za-z_]+", text[max(0, start - 40) : start].lower())[::-1][:3]


def votes(text: str, start: int, kind: str, end: int) -> tuple[int, ...]:
    """Each labeler's vote: 1 personal, -1 not, 0 none."""
    span, near = text[start:end], context(text, start)
    digits = sum(c.isdigit() for c in span)
    letters = sum(c.isalpha() for c in span)
    announced = any(w in SECRET_WORDS for w in near) if kind == "secret" else any(w in CONTACT_WORDS for w in near)
    both = digits >= 4 and letters >= 4 and any(a.isdigit() != b.isdigit() for a, b in zip(span[4:], span[5:]))
    return (
        1 if kind in BASE else 0,
        1 if kind in ("email", "ip", "card") else -1 if kind == "number" and not announced else 0,
        1 if kind == "email" and span.rsplit(".", 1)[-1].lower() in MAIL_DOMAINS else 0,
        1 if announced else 0,
        -1 if any(w in PLAIN_WORDS for w in near[:1]) else 0,
        0 if kind != "secret" else 1 if both else -1,
        0 if kind != "secret" else 1 if text[max(0, start - 1) : start] in ("'", '"') and text[end : end + 1] in ("'", '"') else 0,
        0 if kind != "secret" else -1 if digits == 0 or letters == 0 else 0,
    )


def features(text: str, start: int, kind: str, end: int) -> list[int]:
    """Hashed features of a span and of what stands before it."""
    span, near = text[start:end], context(text, start)
    shape = re.sub(r"(.)\1+", r"\1+", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", span[:64]))))[:16]
    digits = 10 * sum(c.isdigit() for c in span) // len(span)
    named = [f"kind {kind}", f"shape {shape}", f"{kind} digits {digits}", f"length {kind} {len(span).bit_length()}",
             f"before {text[max(0, start - 1):start]}", *[f"near {w}" for w in near],
             *[f"{kind} secret word" for w in near if w in SECRET_WORDS], *[f"{kind} contact word" for w in near if w in CONTACT_WORDS]]
    return [zlib.crc32(x.encode()) % FEATURES for x in named]


def reliabilities(rows: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of personal spans; per class and labeler the chance that a vote cast is positive; chance of each row.

    ``rows`` are distinct vote rows. The start is the majority vote. Not voting
    says nothing. The prior is ``PRIOR_VOTES`` votes, nine in ten of them right.
    """
    p = 1 / (1 + np.exp(-rows.sum(axis=1).astype(float)))
    for _ in range(rounds):
        share = (counts @ p + PRIOR_VOTES) / (counts.sum() + 2 * PRIOR_VOTES)
        positive = np.array([
            ((counts * q) @ (rows > 0) + prior * PRIOR_VOTES) / ((counts * q) @ (rows != 0) + PRIOR_VOTES)
            for q, prior in ((1 - p, 0.1), (p, 0.9))
        ])
        score = np.log((1 - share, share)) + np.where(
            rows[:, None] > 0, np.log(positive), np.where(rows[:, None] < 0, np.log1p(-positive), 0.0)
        ).sum(axis=2)
        p = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
    return float(share), positive, p


def fit_classifier(found: list[list[int]], p: np.ndarray, rounds: int = 200, rate: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on probable labels; the last one is the constant."""
    weights = np.zeros(FEATURES + 1)
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    column = np.fromiter((x for f in found for x in f), np.int64)
    for _ in range(rounds):
        z = np.bincount(row, weights[column], len(found)) + weights[-1]
        gap = p - 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        step = np.bincount(column, gap[row], FEATURES)
        seen = np.bincount(column, minlength=FEATURES) + 1.0
        weights[:-1] += rate * (step / seen - 1e-3 * weights[:-1])
        weights[-1] += rate * gap.mean()
    return weights


def _voted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (",".join(map(str, votes(t, *s))), features(t, *s), zlib.crc32(t[s[0] : s[2]].encode("utf-8", "replace")))
            for t in batch["text"] if t for s in candidates(t)
        ]
        yield pd.DataFrame(rows, columns=["votes", "features", "h"])


def train(docs: DataFrame, limit: int = TRAINING_SPANS) -> np.ndarray | None:
    """The span classifier's weights; None without candidates."""
    voted = stored(spread(docs.select("text")).mapInPandas(_voted, "votes string, features array<int>, h bigint"), "votes")
    counted = voted.groupBy("votes").count().orderBy("votes").collect()
    if not counted:
        return None
    rows = np.array([[int(v) for v in r["votes"].split(",")] for r in counted])
    _, _, p = reliabilities(rows, np.array([r["count"] for r in counted], float))
    chance = dict(zip((r["votes"] for r in counted), p))
    # Rows of one hash are alike in their span; further columns settle which of them are taken.
    sample = voted.orderBy("h", "votes", "features").limit(limit).collect()
    return fit_classifier([r["features"] for r in sample], np.array([chance[r["votes"]] for r in sample]))


def find_spans(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """Per row: ``doc_id`` and ``spans``, an array of (start, kind, end, base)."""

    def spans(text: str | None) -> list[tuple]:
        found = []
        for start, kind, end in candidates(text) if text else []:
            base = kind in BASE
            if base or (weights is not None and weights[features(text, start, kind, end)].sum() + weights[-1] >= np.log(KEEP / (1 - KEEP))):
                found.append((start, kind, end, base))
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [spans(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "spans": [[dict(zip(("start", "kind", "end", "base"), s)) for s in row] for row in found],
            })

    kind = "array<struct<start:bigint,kind:string,end:bigint,base:boolean>>"
    return spread(docs.select("doc_id", "text")).mapInPandas(run, f"doc_id bigint, spans {kind}")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_spans(docs, train(docs))
    base = F.filter("spans", lambda s: s["base"])
    count_of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    written = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id",
        *[count_of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
