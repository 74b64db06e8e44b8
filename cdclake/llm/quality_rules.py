"""Quality rules: counts of a text, and how much more like trusted text than like the corpus it reads.

The words of every document and the last three characters of each word (its
n-grams) are hashed into ``BUCKETS`` buckets. Their counts over all trusted documents and over the whole corpus give
two multinomials; a document's score is the mean, over its n-grams,
of the logarithm of the ratio of the two probabilities, and its span score is
the least mean of any ``SPAN`` words in a row, which clean words around them
cannot raise. Built-in functions only.

Both scores have to reach what nearly all good documents reach: one trusted
document in ``HELD`` is scored by counts of the others, and each score's limit is
its quantile ``LOST`` over those. If no document can be held back, all trusted ones
set the limits, lowered by ``MARGIN``. ``THRESHOLD`` is the least limit of the score.

Cases: a NULL or empty text has no words, all counts 0, no score, and fails the
base rules. Repeated rows are judged alike. An empty corpus gives no rows.
Without trusted documents no document can be told from the corpus, so the base
rules alone decide. Other columns of the input pass through; a column named
like one of the results is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cdclake.llm.common import stored, table, words_of

#: Size of both multinomials; what the driver holds is this many numbers.
BUCKETS = 1 << 17
#: Buckets put together in one step before all of them are.
SLICE = 1 << 12
#: Up to so many trusted ids are broadcast; beyond, Spark chooses the join.
BROADCAST_IDS = 1_000_000
#: Mean log-likelihood ratio below which a document is rejected, whatever the held-back ones score.
THRESHOLD = -1.0
#: Words in a row that are judged by themselves.
SPAN = 5
#: One trusted document in so many, by a hash of its id, is held back to set the limits of both scores.
HELD = 5
#: Share of held-back documents that may miss a limit.
LOST = 0.005
#: Limits are multiples of this.
STEP = 1e-4
#: How far below the trusted documents' own scores a document may stay, if none of them could be held back.
MARGIN = 0.5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "span_score", "kept"]


def _grams(word: Column, buckets: Column) -> list[Column]:
    """The buckets of a word and of its ending; the constants keep the two kinds apart."""
    return [
        F.pmod(F.xxhash64(word), buckets).cast("int"),
        F.pmod(F.xxhash64(F.substring(word, -3, 3), F.lit(3)), buckets).cast("int"),
    ]


def _held(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("held"), doc_id), F.lit(HELD)) == 0


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled good and not toxic."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
    return good.select("doc_id").distinct()


def log_ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row with the arrays ``ratios`` and ``learned``: the log ratio of each bucket. NULL without a trusted word.

    ``learned`` takes the held-back documents for untrusted ones. Each task
    sends a row per bucket at most, however hot a word is.
    """
    flag = trusted.select(F.col("doc_id").alias("__trusted"))
    if flag.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        flag = F.broadcast(flag)
    words = (
        docs.select(F.col("doc_id").alias("__id"), "text")
        .join(flag, F.col("__id") == F.col("__trusted"), "left")
        .select(
            F.col("__trusted").isNotNull().alias("good"),
            (F.col("__trusted").isNotNull() & ~_held(F.col("__trusted"))).alias("learned"),
            F.explode(words_of(F.col("text"))).alias("word"),
        )
    )
    grams = words.select("good", "learned", F.explode(F.array(*_grams(F.col("word"), F.lit(BUCKETS)))).alias("bucket"))
    counts = stored(grams.groupBy("bucket").agg(
        F.count("*").alias("n"), F.count_if("good").alias("n_good"), F.count_if("learned").alias("n_learned")
    ), "bucket-counts")
    total, *trusted_totals = (x or 0 for x in counts.agg(F.sum("n"), F.sum("n_good"), F.sum("n_learned")).first())

    def ratio(n_trusted: str, of: int) -> Column:
        # Both multinomials on the trusted total and smoothed by one count, so that few trusted words say little.
        expected = F.coalesce("n", F.lit(0)) * F.lit(of / total if total else 0.0)
        return (F.log(F.coalesce(n_trusted, F.lit(0)) + 1) - F.log(expected + 1)).cast("float")

    names = ["ratios", "learned"]
    each = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    entry = F.struct("bucket", *[ratio(c, of).alias(x) for x, c, of in zip(names, ["n_good", "n_learned"], trusted_totals)])
    sliced = each.groupBy(F.floor(F.col("bucket") / SLICE).alias("slice")).agg(F.sort_array(F.collect_list(entry)).alias("seen"))
    sliced = sliced.select("slice", *[F.col(f"seen.{x}").alias(x) for x in names])
    whole = sliced.agg(F.sort_array(F.collect_list(F.struct("slice", *names))).alias("all"))
    return whole.select(*[
        (F.flatten(F.col(f"all.{x}")) if of else F.lit(None).cast("array<float>")).alias(x) for x, of in zip(names, trusted_totals)
    ])


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for the row, and no row written in between."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows of ``WINDOW`` words that occur twice or more; equal hashes mean equal words."""
    windows = F.when(
        F.size(hashes) >= WINDOW,
        F.transform(
            F.slice(hashes, 1, F.size(hashes) - WINDOW + 1),
            lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("words"))

    def covered(ranked: Column) -> Column:
        twice = F.filter(ranked, lambda x, k: same(F.get(ranked, k - 1), x) | same(F.get(ranked, k + 1), x))
        return F.aggregate(
            F.sort_array(F.transform(twice, lambda x: x["i"])), start,
            lambda acc, p: F.struct(
                p.alias("last"), (acc["words"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("words")
            ),
            lambda acc: acc["words"],
        )

    def counted(found: Column) -> Column:
        ranked = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) < F.size(found), _let(ranked, covered)).otherwise(F.lit(0))

    return _let(windows, counted)


def _scores(sums: Column) -> Column:
    """Both scores of a text, of the sums of its words' two log ratios; a text of fewer words than a span is one span."""
    n = F.size(sums)
    whole = F.when(n > 0, F.aggregate(sums, F.lit(0.0), lambda acc, x: acc + x) / (2 * n))
    spans = F.transform(
        F.slice(sums, 1, F.greatest(n - SPAN + 1, F.lit(0))),
        lambda x, i: sum((F.get(sums, i + k) for k in range(1, SPAN)), x),
    )
    return F.struct(
        whole.alias("score"), F.when(n >= SPAN, F.array_min(spans) / (2 * SPAN)).otherwise(whole).alias("span_score")
    )


def quality_counts(docs: DataFrame, ratios: Column | None = None) -> DataFrame:
    """``docs`` with the base counts and ``base_failed``; with ``ratios``, also ``score`` and ``span_score``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def measured(words: Column, known: Column) -> Column:
        n_words = F.size(words).cast("bigint")
        repeated = _let(F.transform(words, lambda w: F.xxhash64(w)), _repeated_words).cast("bigint")
        scores = F.struct(F.lit(None).cast("double").alias("score"), F.lit(None).cast("double").alias("span_score"))
        if ratios is not None:
            # Without ratios their size is NULL, and so is the bucket.
            of = lambda b: F.coalesce(F.get(known, b), F.lit(0.0).cast("float"))
            grams = lambda w: _grams(w, F.size(known))
            scores = _let(F.transform(words, lambda w: sum(of(b) for b in grams(w)).cast("double")), _scores)
        return F.struct(
            n_words.alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("bigint").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            repeated.alias("n_repeat_words"),
            scores.alias("scores"),
        )

    # The ratios are named once: each mention would send them to the tasks once more.
    given = docs.drop(*RESULTS).withColumn("__ratios", F.lit(None).cast("array<float>") if ratios is None else ratios)
    found = _let(F.col("__ratios"), lambda known: _let(words_of(F.col("text")), lambda words: measured(words, known)))
    return (
        given.withColumn("__found", found)
        .select(*[c for c in docs.columns if c not in RESULTS], "__found.*")
        .select("*", "scores.*").drop("scores")
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                    | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))
    )


def _quantile(scored: DataFrame, column: str) -> float | None:
    """The greatest multiple of ``STEP`` that all but ``LOST`` of the scores reach; the same in every run.

    Counted per step, of which a logarithm's range has some hundred thousand, whatever the number of rows.
    """
    steps = scored.where(F.col(column).isNotNull()).groupBy(F.floor(F.col(column) / STEP).alias("step")).agg(F.count("*").alias("n"))
    upto = steps.select("step", F.sum("n").over(Window.orderBy("step")).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("all"))
    least = upto.where(F.col("upto") >= F.col("all") * LOST).agg(F.min("step")).first()[0]
    return None if least is None else least * STEP


def limits(docs: DataFrame, trusted: DataFrame, learned: Column) -> tuple[float | None, float | None]:
    """What all but ``LOST`` of the held-back trusted documents reach, in score and span score; None without any words.

    Where there are too few trusted documents to hold any back, they all set the
    limits, lowered by ``MARGIN``, since documents that were learned from score too high.
    """
    texts = docs.select("doc_id", "text")
    # Stored before they are counted and before they are filtered: Spark would else count them once per condition.
    held = stored(texts.join(trusted.where(_held(F.col("doc_id"))), "doc_id", "left_semi"), "held-back")
    margin = 0.0
    if held.isEmpty():
        held, margin = stored(texts.join(trusted, "doc_id", "left_semi"), "held-back"), MARGIN
    scored = stored(quality_counts(held, learned).select("base_failed", "score", "span_score"), "held-back-scores")
    found = [_quantile(scored.where(~F.col("base_failed")), c) for c in ("score", "span_score")]
    return tuple(None if x is None else x - margin for x in found)


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, both scores (NULL without words) and ``kept``."""
    trusted = trusted_ids(labels)
    ratios = stored(log_ratios(docs, trusted), "log-ratios")
    least, least_span = limits(docs, trusted, ratios.select("learned").scalar())
    scored = quality_counts(docs, ratios.select("ratios").scalar())
    reached = F.coalesce("score", F.lit(0.0)) >= (threshold if least is None else max(threshold, least))
    if least_span is not None:
        reached &= F.coalesce("span_score", F.lit(0.0)) >= least_span
    return scored.withColumn("kept", ~F.col("base_failed") & reached)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *RESULTS)
