"""The change log: bounded reads, union of logs, routing to one stream per table."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cdclake.operators.envelope import table_key


def read_changes(log: DataFrame, after_id: int, up_to_id: int | None = None) -> DataFrame:
    """Events after one log position and up to another. Sources evaluate the range themselves."""
    events = log.where(F.col("id") > after_id)
    return events if up_to_id is None else events.where(F.col("id") <= up_to_id)


def read_topic(spark: SparkSession, servers: str, topic: str, starting: dict | str = "earliest",
               ending: dict | str = "latest", **options: str) -> DataFrame:
    """A bounded read of a Kafka topic. Needs the Kafka connector on the class path."""

    def position(p):
        return p if isinstance(p, str) else json.dumps(p)

    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", position(starting))
        .option("endingOffsets", position(ending))
        .options(**options)
        .load()
    )


def union_changes(*logs: DataFrame) -> DataFrame:
    """The distinct events of several logs; columns some of them lack are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs).distinct()


def change_messages(changes: DataFrame) -> DataFrame:
    """Events as keyed messages, each for its own table's stream."""
    event = [c for c in changes.columns if c != "table_key"]
    return changes.select(
        table_key().alias("topic"),
        F.concat_ws("-", "database_url", "database_port", "database_name", F.lower("table_name")).alias("key"),
        F.to_json(F.struct(*event)).alias("value"),
    )


def route_changes(changes: DataFrame, sink: str, format: str = "parquet", **options: str) -> None:
    """Append events to one stream per table: a folder under ``sink``, or a Kafka topic.

    For ``kafka``, ``sink`` names the servers. Each event goes by its own
    columns, so the log needs no sort. File output is rebalanced per table; a
    table with a large share of the events is split over several files.
    """
    if format == "kafka":
        change_messages(changes).write.format("kafka").option("kafka.bootstrap.servers", sink).options(**options).save()
        return
    keyed = changes.drop("table_key").withColumn("table_key", table_key())
    keyed.hint("rebalance", "table_key").write.mode("append").format(format).options(**options).partitionBy(
        "table_key"
    ).save(sink)
