"""How far changes and jobs have got."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from cdclake.model import RUN_LOG, STATUS_ORDER
from cdclake.operators.columns import col, resolve
from cdclake.operators.envelope import table_key


def change_watermarks(changes: DataFrame, by: str = "table") -> DataFrame:
    """Newest log position and number of events per table, or per server with ``by="server"``."""
    if by not in ("table", "server"):
        raise ValueError(f"unknown grouping {by!r}")
    groups = [table_key().alias("table_key")] if by == "table" else ["database_url", "database_port"]
    return changes.groupBy(*groups).agg(F.max("id").alias("max_id"), F.count(F.lit(1)).alias("events"))


def cdc_lag(log: DataFrame, applied: DataFrame) -> DataFrame:
    """Tables of a log with the newest position there, the one applied, and whether changes wait.

    ``applied`` holds ``table_key, last_id``; a table never applied counts from 0.
    The log is reduced to one row per table before the join.
    """
    latest = change_watermarks(log).select("table_key", F.col("max_id").alias("latest_id"))
    done = applied.groupBy("table_key").agg(F.max("last_id").alias("applied_id"))
    applied_id = F.coalesce("applied_id", F.lit(0).cast("bigint"))
    return latest.join(done, "table_key", "left").select(
        "table_key",
        "latest_id",
        applied_id.alias("applied_id"),
        F.greatest(F.col("latest_id") - applied_id, F.lit(0).cast("bigint")).alias("lag"),
        (applied_id < F.col("latest_id")).alias("is_ready"),
    )


def latest_per_key(df: DataFrame, keys: str | Iterable[str], order_by: str | Iterable[str]) -> DataFrame:
    """The newest rows of every key, ties included: rank 1 by ``order_by``, each descending, NULLs last.

    The greatest ordering values per key come from a partial aggregate over
    those columns alone; the rows are then picked by a semi-join. A ranking
    window would hold all rows of a key, or all ties, in one task.
    """
    keys, order = resolve(df, keys), resolve(df, order_by)
    best = df.groupBy(*[col(k) for k in keys]).agg(F.max(F.struct(*[col(c) for c in order])).alias("_best"))
    # Own names on this side, so the self-join has no ambiguous columns.
    best = best.select(
        *[col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[F.col("_best")[c].alias(f"_o{i}") for i, c in enumerate(order)],
    )
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & col(k).eqNullSafe(F.col(f"_k{i}"))
    for i, c in enumerate(order):
        match = match & col(c).eqNullSafe(F.col(f"_o{i}"))
    return df.join(best, match, "left_semi")


def run_event(step: int, status: str, message: str, **fields) -> tuple:
    """One run-log row, in the order of ``RUN_LOG``."""
    values = {"step": step, "status": status, "message": message, "statusOrder": STATUS_ORDER[status], **fields}
    return tuple(values.get(f.name) for f in RUN_LOG.fields)


def status_order() -> Column:
    order: Column = F.lit(None).cast("int")
    for status, rank in STATUS_ORDER.items():
        order = F.when(F.col("status") == status, F.lit(rank)).otherwise(order)
    return order


def append_run_log(events: DataFrame, path: str) -> None:
    """Append step events to the stored run log, with the order their status stands for."""
    if "statusOrder" not in events.columns:
        events = events.withColumn("statusOrder", status_order())
    have = set(events.columns)
    events.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN_LOG.fields
    ]).write.mode("append").parquet(path)


def run_progress(run_log: DataFrame) -> DataFrame:
    """Steps finished, failed and open per job, and the job's latest status.

    A step stands where its last event puts it; of events with the same time the
    status order decides. Time and status go into one number per event, so both
    levels are hash aggregates with a partial step, and a job with a large share
    of the log is no hot spot.
    """
    # The time's digits, to the millisecond, are at most 17.
    time = F.rpad(F.translate(F.substring("create_time", 1, 23), "/-: .T", ""), 17, "0").try_cast("bigint")
    at = F.coalesce(time, F.lit(0)) * 4 + F.coalesce(status_order(), F.lit(0))
    steps = run_log.select("job_id", "step", "number_step", at.alias("at")).groupBy("job_id", "step").agg(
        F.max("at").alias("at"), F.max("number_step").alias("number_step")
    )
    order = {name: F.col("at") % 4 == rank for name, rank in STATUS_ORDER.items()}
    jobs = steps.groupBy("job_id").agg(
        F.max("number_step").alias("number_step"),
        F.count_if(order["success"]).alias("finished"),
        F.count_if(order["fail"]).alias("failed"),
        F.count_if(order["processing"]).alias("open"),
        F.max("at").alias("at"),
    )
    last: Column = F.lit(None).cast("string")
    for name, is_last in order.items():
        last = F.when(is_last, F.lit(name)).otherwise(last)
    return jobs.select("job_id", "number_step", "finished", "failed", "open", last.alias("last_status"))
