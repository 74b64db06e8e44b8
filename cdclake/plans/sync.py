"""From change events to table copies and the consolidated tables they feed."""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from cdclake.model import Mapping, RUN_LOG
from cdclake.operators.apply import merge_delta, stage_delta, written_rows
from cdclake.operators.consolidate import consolidate, map_columns, propagate_changes
from cdclake.operators.envelope import decode_changes
from cdclake.operators.members import FED, refresh_member, with_member
from cdclake.operators.progress import append_run_log, run_event
from cdclake.operators.versioned import merge_versions, propagate_versions, with_before_images
from cdclake.session import work_path
from cdclake.sources.tables import delete, exists, recover_table, replace_table
from cdclake.sources.versions import read_table


@dataclass
class MergeTarget:
    """A consolidated table that a member table feeds; ``versioned`` keeps it as versions."""

    path: str
    mapping: list[Mapping]
    alias: str
    mode: str = "replace"
    partition_by: str = ""
    versioned: bool = False


@dataclass
class TableTarget:
    """Where and how the changes of one table are applied.

    ``versioned`` keeps the copy as versions. ``start_after`` is the position the
    copy holds from its snapshot, and ``max_retries`` overrides the handler's.
    """

    path: str
    key: str
    table: str
    dialect: str = "mysql"
    partition_by: str = ""
    merges: list[MergeTarget] = field(default_factory=list)
    versioned: bool = False
    start_after: int | None = None
    max_retries: int | None = None


class RunLog:
    """Step events of one run, kept until they are appended to the stored log."""

    def __init__(self, **fields):
        self.fields, self.events = fields, []

    def add(self, step: int, status: str, message: str) -> None:
        now = time.time()
        stamp = time.strftime("%Y/%m/%d %H:%M:%S", time.gmtime(now)) + ".%03d" % (now % 1 * 1000)
        self.events.append(run_event(step, status, message, create_time=stamp, **self.fields))

    @contextmanager
    def step(self, number: int, message: str):
        self.add(number, "processing", message)
        try:
            yield
        except Exception:
            self.add(number, "fail", message)
            raise
        self.add(number, "success", message)


def store_run_logs(spark: SparkSession, logs: list[RunLog], path: str) -> None:
    """Append the step events of several runs in one write."""
    events = [event for log in logs for event in log.events]
    if events:
        append_run_log(spark.createDataFrame(events, RUN_LOG).coalesce(1), path)


def sync_table(spark: SparkSession, events: DataFrame, target: TableTarget, quarantine: str, log: RunLog) -> None:
    """Apply one table's events to its copy and pass them on to the consolidated tables.

    The events are decoded and compacted once; the stored delta serves the copy
    and every consolidated table. All steps may be repeated.
    """
    seen = Observation()
    with log.step(1, "decode changes"):
        rows, rejected = decode_changes(events, target.dialect, observation=seen)
    readable = len(rows.columns) > 2
    if readable:
        with log.step(2, "compact changes"):
            delta, staged = stage_delta(rows, target.key)
    if not readable or seen.get["undecoded"] or seen.get["unfit"]:
        rejected.write.mode("overwrite").parquet(quarantine)
    if not readable:
        return  # no event names a column
    work = [staged]
    try:
        with log.step(3, "merge into table"):
            # What the copy still holds of changed keys is read before it changes.
            fed = [_with_old_values(spark, delta, target, merge, work) for merge in target.merges]
            if target.versioned:
                merge_versions(spark, target.path, delta, target.key, target.partition_by)
            else:
                merge_delta(spark, target.path, delta, target.key, target.partition_by)
        for number, (merge, changes) in enumerate(zip(target.merges, fed), start=4):
            with log.step(number, f"merge into {merge.path}"):
                _merge_into(spark, changes, target, merge)
    finally:
        for path in work:
            delete(spark, path)


def _with_old_values(spark: SparkSession, delta: DataFrame, target: TableTarget, merge: MergeTarget, work: list[str]) -> DataFrame:
    """The delta with deletes for unique values it does away with, stored where there can be any."""
    if not exists(spark, target.path):
        return delta
    copy = read_table(spark, target.path)
    full = with_before_images(delta, copy, target.key, merge.mapping, target.table, merge.alias)
    if full is delta:
        return delta
    work.append(work_path(spark, "delta"))
    full.write.parquet(work[-1])
    return spark.read.schema(full.schema).parquet(work[-1])


def _merge_into(spark: SparkSession, delta: DataFrame, target: TableTarget, merge: MergeTarget) -> None:
    """Pass a member's delta on to a consolidated table, which it starts if there is none."""
    if merge.versioned:
        propagate_versions(spark, merge.path, delta, merge.mapping, target.table, merge.alias, merge.mode, merge.partition_by)
        return
    recover_table(spark, merge.path)
    if exists(spark, merge.path):
        merged = propagate_changes(
            spark.read.parquet(merge.path), delta, merge.mapping, target.table, merge.alias, merge.mode, measure=True
        )
    else:
        merged = map_columns(written_rows(delta, "seq", "operation"), merge.mapping, target.table, merge.alias)
        if merge.mode == "members":
            merged = with_member(merged, merge.mapping, target.table, merge.alias)
    replace_table(merged, merge.path, merge.partition_by)


def consolidate_table(
    spark: SparkSession, path: str, member: DataFrame, mapping: list[Mapping], table: str, alias: str,
    track: bool = False,
) -> DataFrame:
    """Bring a member table into a stored consolidated table, which it starts if there is none; the new table.

    A member brought in before is refreshed. A table started with ``track`` records
    its members, so that a refresh leaves no value or row that nobody feeds.
    """
    recover_table(spark, path)
    stored = spark.read.parquet(path) if exists(spark, path) else None
    new = map_columns(member, mapping, table, alias)
    if (stored is None and track) or (stored is not None and FED in stored.columns):
        merged = refresh_member(stored, new, mapping, table, alias, measure=True, refuse_repeats=True)
    else:
        merged = consolidate(stored, new, mapping, measure=True, refresh=True, refuse_repeats=True)
    replace_table(merged, path)
    return spark.read.parquet(path)
