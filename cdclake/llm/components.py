"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cdclake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it can reach, of links with ``a`` and ``b``.

    Each round points the larger neighbours of a node, then the smaller ones, to
    its least neighbour, until nothing changes: a number of rounds that grows
    with the logarithm of the longest chain. A node with very many links reaches
    the aggregates as one row a task; its rows in the joins are split by
    adaptive execution. Only a count and a checksum come to the driver.
    """
    edges = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(
            small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small-star"
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
