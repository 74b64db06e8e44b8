"""What several operators of this package share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cdclake.session import work_path

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting to delete the shuffle files of a query at its end, not when the driver's memory is next cleared.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again, which cuts its lineage.

    The files of its shuffles go with the end of the write, since what is stored needs them no more.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of frames that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def words_of(text: Column) -> Column:
    """The words of a text; none for NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def spread(df: DataFrame) -> DataFrame:
    """At least as many partitions as cores: a single small file is else one task."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
