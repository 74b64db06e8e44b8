"""Mixing sources to target weights.

Words are summed per source; the targets share the total by weight, none above
``max_repeats`` times its source. A source's rate is its target by its size. A
document is emitted floor(rate) times, and once more if a number hashed from its
id and source lies below the fraction, so reruns agree.

Cases: a NULL or empty text has size 0 and takes nothing. A NULL source is a
source of its own, the last in order. Rows with equal id and source share one
draw. Empty tables give no rows. A source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cdclake.llm.common import WORD, stored, table

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows with ``source`` and ``size``.

    Sources are numbered by a distributed sort; the driver sees three sums a round.
    """
    spark = sizes.sparkSession
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    order = totals.orderBy(F.col("source").asc_nulls_last())
    schema = T.StructType([*totals.schema.fields, T.StructField("weight", T.LongType())])
    ranked = order.rdd.zipWithIndex().map(lambda x: (*x[0], weights[x[1] % len(weights)]))
    weighed = stored(spark.createDataFrame(ranked, schema), "source-weights")
    most, share, level = F.col("source_size") * max_repeats, None, None
    while True:
        # Sources at their limit under the level so far stay there: the level only rises.
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > most
        total, held, open_weight = weighed.agg(
            F.sum("source_size"), F.sum(F.when(full, most).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        share = (total - held) / open_weight if open_weight else 0.0
        if share == level:
            break
        level = share
    target = F.col("weight") * F.lit(float(level))
    return weighed.select(
        "source", "source_size", F.when(target > most, most.cast("double")).otherwise(target).alias("target")
    )


def draw(*keys: Column) -> Column:
    """A number in [0, 1) hashed from the keys, the same in every run."""
    text = F.concat_ws(":", F.lit(SEED), *[F.coalesce(k.cast("string"), F.lit("?")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix_rates(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``copies``.

    The join with the sources carries no text. Spark broadcasts the sources if
    their stored table is small, and otherwise splits a hot source's rows.
    """
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    targets = source_targets(sizes, weights, max_repeats).withColumnRenamed("source", "__source")
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(max_repeats)), F.col("target") / F.col("source_size")))
    rated = sizes.join(targets, F.col("source").eqNullSafe(F.col("__source"))).withColumn("__rate", F.coalesce(rate, F.lit(0.0)))
    extra = draw(F.col("doc_id"), F.col("source")) < F.col("__rate") - F.floor("__rate")
    return rated.withColumn("copies", (F.floor("__rate") + extra.cast("int")).cast("bigint")).drop("__source", "__rate")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it."""
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = source_targets(sizes, weights, max_repeats)
    rates = targets.select(
        F.col("source").alias("__source"),
        F.when(F.col("source_size") > 0, F.least(F.lit(float(max_repeats)), F.col("target") / F.col("source_size")))
        .otherwise(0.0).alias("__rate"),
    )
    extra = draw(F.col("doc_id"), F.col("source")) < F.col("__rate") - F.floor("__rate")
    copies = (F.floor("__rate") + extra.cast("int")).cast("int")
    return (
        docs.join(rates, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies)))
        .select(*docs.columns)
    )


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_rates(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


ORACLE = r"""
with recursive sizes as (
    select doc_id, source,
        cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
    from documents
), totals as (
    select source, cast(sum(size) as bigint) as source_size from sizes group by source
), weighed as (
    select *, cast(1 + (row_number() over (order by source nulls last) - 1) % 3 as bigint) as weight from totals
), levels(round, level) as (
    select 0, cast((select sum(source_size) from weighed) as double) / (select sum(weight) from weighed)
    union all
    select round + 1, (
        select cast(sum(source_size) - sum(case when weight * level > 3 * source_size then 3 * source_size else 0 end) as double)
            / sum(case when weight * level > 3 * source_size then 0 else weight end) from weighed)
    from levels where round < 40
), last as (
    select level from levels order by round desc limit 1
), targets as (
    select source, source_size,
        case when weight * level > 3 * source_size then cast(3 * source_size as double) else weight * level end as target
    from weighed, last
), rated as (
    select s.doc_id, s.size, t.source_size, t.target,
        case when t.source_size > 0 then least(3.0::double, t.target / t.source_size) else 0.0::double end as rate,
        cast(cast('0x' || substr(md5('mix-1:' || coalesce(cast(s.doc_id as varchar), '?') || ':' || coalesce(s.source, '?')), 1, 13) as ubigint) as double)
            / 4503599627370496.0::double as draw
    from sizes s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
    cast(size * (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end) as bigint) as taken
from rated
"""
