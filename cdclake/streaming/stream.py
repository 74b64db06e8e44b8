"""Changes as a stream: micro-batches, applied so that a repeated batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from cdclake.model import APPLY_REQUEST, CHANGE, Mapping, RUN_LOG, TableRef, merge_table_path
from cdclake.operators.envelope import decode_envelope, decode_requests, table_key
from cdclake.plans.query import run_queries
from cdclake.plans.sync import MergeTarget, RunLog, TableTarget, consolidate_table, store_run_logs, sync_table
from cdclake.sources.tables import exists, recover_table, replace_table

__all__ = [
    "ApplyRegistry", "ChangeApplier", "MergeTarget", "QueryRunner", "TableMerger", "TableTarget", "read_stream", "stream_changes", "stream_run_log",
]

APPLIED = "table_key string, last_id bigint, batch_id bigint"
FAILURES = "table_key string, status string, batch_id bigint, error string, at timestamp"
UNREGISTERED = "unregistered table"


def read_stream(spark: SparkSession, source: str, format: str = "json", schema: T.StructType | None = None,
                topics: str | None = None, **options: str) -> DataFrame:
    """A stream of change events from files of a folder, or of messages from Kafka.

    For ``kafka``, ``source`` names the servers and ``topics`` the subscription;
    it needs the Kafka connector on the class path.
    """
    if format == "kafka":
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", source)
            .option("subscribe", topics)
            .option("startingOffsets", "latest")
            .option("failOnDataLoss", "false")
            .options(**options)
            .load()
        )
        return raw if schema is not None else decode_envelope(raw)
    return spark.readStream.format(format).schema(schema or CHANGE).options(**options).load(source)


def stream_changes(
    spark: SparkSession,
    source: str | DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    format: str = "json",
    topics: str | None = None,
    once: bool = False,
    **options: str,
) -> StreamingQuery:
    """Feed micro-batches of change events, or of request messages, to a handler, keeping progress in ``checkpoint``.

    A batch whose handler fails is run again from the checkpoint. ``once`` takes
    what is there and stops.
    """
    events = source if isinstance(source, DataFrame) else read_stream(spark, source, format, topics=topics, **options)
    writer = events.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


class ChangeApplier:
    """A batch handler that merges each table's events into its copy.

    Three records make a repeat harmless and a late event visible: the merge
    itself is an upsert, events up to a table's last applied position are not
    applied again, and the positions of applied events are kept. An event at or
    below the last position that is none of those is late, whatever the number of
    its batch and the stream it comes from, and goes to ``quarantine``, as do
    events that cannot be decoded or whose table has no target. Positions are
    looked up only for a table that has events behind its last one. Steps are
    noted in ``run_log``.

    Up to ``parallel`` tables are applied at a time, since one small merge does
    not fill a cluster. Tables that feed the same consolidated table take turns.
    When one table fails, what the others did is recorded before the batch fails,
    and the stream runs the batch again. With ``max_retries``, a table that has
    failed so often in a row is set aside: its events go to the quarantine, the
    batch succeeds, and the other tables move on. ``resume`` takes it up again
    from its last applied position.

    ``targets`` may be a registry of apply requests, which is read for every batch.
    A table registered after some of its events came gets those from the
    quarantine, with its first batch; events up to its ``start_after`` are in its
    snapshot and are left out.
    """

    def __init__(self, spark: SparkSession, targets: dict[str, TableTarget] | Callable[[], dict[str, TableTarget]], state: str, quarantine: str,
                 run_log: str | None = None, parallel: int = 4, compact_state_every: int = 100, max_retries: int | None = None):
        self.spark, self.state, self.quarantine = spark, state, quarantine
        self.registry = targets if callable(targets) else None
        self.targets: dict[str, TableTarget] = {} if callable(targets) else targets
        self.run_log, self.parallel, self.compact_state_every, self.max_retries = run_log, parallel, compact_state_every, max_retries
        self.positions, self.failures = f"{state}-positions", f"{state}-failures"

    def applied(self) -> DataFrame:
        """Last applied position per table."""
        recover_table(self.spark, self.state)
        if not exists(self.spark, self.state):
            return self.spark.createDataFrame([], APPLIED)
        rows = self.spark.read.schema(APPLIED).parquet(self.state)
        return rows.groupBy("table_key").agg(F.max("last_id").alias("last_id"), F.max("batch_id").alias("batch_id"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.registry:
            self.targets = self.registry()
        begun = {r["table_key"]: r["last_id"] for r in self.applied().where(F.col("table_key").isin(list(self.targets))).collect()}
        batch = batch.drop("table_key").withColumn("table_key", table_key())
        starting = self._failed([key for key in self.targets if key not in begun])
        waiting = self._waiting([key for key, failures in starting.items() if failures is not None])
        if waiting is not None:
            batch = batch.unionByName(waiting, allowMissingColumns=True)
        # The batch is read several times; the source should be read once.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._apply(spark, batch, batch_id, begun)
        finally:
            batch.unpersist()

    def _waiting(self, keys: list[str]) -> DataFrame | None:
        """Events set aside before their table was registered; None without such a table.

        One event that was set aside twice counts once, as compaction takes equal positions for one.
        """
        if not keys or not exists(self.spark, self.quarantine):
            return None
        schema = T.StructType([*CHANGE.fields, *(T.StructField(c, T.StringType()) for c in ("reason", "batch", "table_key"))])
        aside = self.spark.read.schema(schema).parquet(self.quarantine)
        return aside.where(F.col("table_key").isin(keys) & (F.col("reason") == UNREGISTERED)).drop("reason", "batch")

    def _apply(self, spark: SparkSession, batch: DataFrame, batch_id: int, begun: dict[str, int]) -> None:
        # One row per table of the batch reaches the driver; the events stay where they are.
        found = {r["table_key"]: r for r in batch.groupBy("table_key").agg(F.min("id").alias("least"), F.max("id").alias("most")).collect()}
        known = [k for k in found if k in self.targets]
        if len(known) < len(found):
            self._set_aside(batch.where(~F.col("table_key").isin(list(self.targets))), batch_id)
        last = {k: self.targets[k].start_after for k in known if self.targets[k].start_after is not None} | begun
        failed_before = self._failed(known)
        logs: list[RunLog] = []
        finished: list[str] = []
        errors: list[Exception] = []
        noted: list[tuple] = []

        def note(key: str, status: str, error: Exception | None = None) -> None:
            noted.append((key, status, batch_id, None if error is None else str(error)[:2000], datetime.now()))

        def sync_in_turn(keys: list[str]) -> None:
            for key in keys:
                target = self.targets[key]
                events = batch.where(F.col("table_key") == key).drop("table_key")
                if key in last:
                    if key in begun and found[key]["least"] is not None and found[key]["least"] <= last[key]:
                        self._set_late_aside(key, events.where(F.col("id") <= last[key]), batch_id)
                    events = events.where(F.col("id").isNull() | (F.col("id") > last[key]))
                if failed_before.get(key) is None:
                    self._set_aside(events.withColumn("table_key", F.lit(key)), batch_id, "table set aside")
                    continue
                log = RunLog(job_id=batch_id, table_name=target.table, request_type="sync_all", number_step=3 + len(target.merges))
                logs.append(log)
                try:
                    # One folder per batch and table: a repeat overwrites its own.
                    sync_table(spark, events, target, f"{self.quarantine}/batch={batch_id}/table_key={key}", log)
                except Exception as error:
                    note(key, "failed", error)
                    allowed = self._retries(key)
                    if allowed is None or failed_before[key] + 1 < allowed:
                        errors.append(error)
                    else:
                        self._set_aside(events.withColumn("table_key", F.lit(key)), batch_id, "table set aside")
                        note(key, "set aside", error)
                    continue
                if failed_before[key]:
                    note(key, "recovered")
                if found[key]["most"] is not None and (key not in last or found[key]["most"] > last[key]):
                    finished.append(key)

        try:
            with ThreadPoolExecutor(self.parallel) as pool:
                runs = [pool.submit(inheritable_thread_target(spark)(sync_in_turn), keys) for keys in self._turns(known)]
            for run in runs:
                run.result()
        finally:
            if finished:
                self._record(spark, batch, {k: last.get(k) for k in finished}, {k: found[k]["most"] for k in finished}, batch_id)
            if noted:
                spark.createDataFrame(noted, FAILURES).coalesce(1).write.mode("append").parquet(self.failures)
            if self.run_log:
                store_run_logs(spark, logs, self.run_log)
        if errors:
            raise errors[0]
        if batch_id and batch_id % self.compact_state_every == 0 and exists(spark, self.state):
            replace_table(self.applied().coalesce(1), self.state)
            if exists(spark, self.positions):
                kept = spark.read.parquet(self.positions).distinct()
                replace_table(kept.repartitionByRange("table_key", "id").sortWithinPartitions("table_key", "id"), self.positions)

    def _record(self, spark: SparkSession, batch: DataFrame, last: dict, most: dict, batch_id: int) -> None:
        """Keep the positions of what was applied, then the last one of each table.

        Between the two a failure leaves positions above the last one, which are applied again.
        """
        fresh = F.lit(False)
        for key, position in last.items():
            above = F.lit(True) if position is None else F.col("id") > position
            fresh = fresh | ((F.col("table_key") == key) & above)
        applied = batch.where(fresh & F.col("id").isNotNull()).select("table_key", F.col("id").cast("bigint").alias("id"))
        recover_table(spark, self.positions)
        self._keep_positions(applied)
        marks = [(key, position, batch_id) for key, position in most.items()]
        spark.createDataFrame(marks, APPLIED).coalesce(1).write.mode("append").parquet(self.state)

    def _set_late_aside(self, key: str, behind: DataFrame, batch_id: int) -> None:
        """Of events behind the last position, those whose position was never applied nor set aside before."""
        spark = self.spark
        recover_table(spark, self.positions)
        if exists(spark, self.positions):
            seen = spark.read.schema("table_key string, id bigint").parquet(self.positions).where(F.col("table_key") == key)
            behind = behind.join(seen.select("id"), "id", "left_anti")
        if behind.isEmpty():
            return
        late = behind.withColumn("table_key", F.lit(key))
        self._set_aside(late, batch_id, "behind applied position")
        self._keep_positions(late.select("table_key", F.col("id").cast("bigint").alias("id")))

    def _keep_positions(self, rows: DataFrame) -> None:
        """Append positions, in as many files as their size asks for.

        Gathered in one task, that task would also sort and join all they come from.
        """
        rows.hint("rebalance", "table_key", "id").write.mode("append").parquet(self.positions)

    def _failed(self, keys: list[str]) -> dict[str, int | None]:
        """How often each table has failed in a row; None for one that is set aside."""
        spark = self.spark
        counts: dict[str, int | None] = dict.fromkeys(keys, 0)
        if all(self._retries(key) is None for key in keys) or not exists(spark, self.failures):
            return counts
        rows = spark.read.schema(FAILURES).parquet(self.failures).where(F.col("table_key").isin(keys))
        # A table that works leaves no rows here, one that does not at most one a try.
        settled = rows.groupBy("table_key").agg(
            F.max(F.when(F.col("status") != "failed", F.col("at"))).alias("since"),
            F.max_by("status", F.struct("at", (F.col("status") != "failed").alias("settles"))).alias("latest"),
        )
        states = rows.join(settled, "table_key").groupBy("table_key", "latest").agg(
            F.count_if((F.col("status") == "failed") & (F.col("since").isNull() | (F.col("at") > F.col("since")))).alias("n")
        )
        for r in states.collect():
            counts[r["table_key"]] = None if r["latest"] == "set aside" else r["n"]
        return counts

    def _retries(self, key: str) -> int | None:
        own = self.targets[key].max_retries
        return self.max_retries if own is None else own

    def resume(self, key: str) -> None:
        """Take up again a table that was set aside; events set aside meanwhile are in the quarantine."""
        row = (key, "resumed", None, None, datetime.now())
        self.spark.createDataFrame([row], FAILURES).coalesce(1).write.mode("append").parquet(self.failures)

    def _set_aside(self, events: DataFrame, batch_id: int, reason: str = UNREGISTERED) -> None:
        """Keep events that are not applied, a folder per batch and reason.

        A repeat overwrites its own, but for late events: those of another stream's
        batch of the same number lie beside them, and a repeat finds them recorded.
        """
        suffix = {UNREGISTERED: "", "behind applied position": "-late"}.get(reason, "-failed")
        mode = "append" if suffix == "-late" else "overwrite"
        events.withColumn("reason", F.lit(reason)).write.mode(mode).option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("table_key").parquet(f"{self.quarantine}/batch={batch_id}{suffix}")

    def _turns(self, keys) -> list[list[str]]:
        """Tables grouped so that no two groups feed the same consolidated table."""
        groups: list[tuple[list[str], set[str]]] = []
        for key in sorted(keys):
            names, paths = [key], {m.path for m in self.targets[key].merges}
            for group in [g for g in groups if g[1] & paths]:
                groups.remove(group)
                names, paths = group[0] + names, group[1] | paths
            groups.append((names, paths))
        return [names for names, _ in groups]


class ApplyRegistry:
    """A batch handler for a stream of apply requests, and the targets they ask for.

    Requests are kept in ``path``, a folder per batch that a repeat overwrites.
    A request without a host, port, database, table or key column is kept apart with
    the ``reason``. Called without arguments, as by ``ChangeApplier`` for every
    batch, the registry gives a target per change stream: that of its newest
    request, which is the one of the latest batch, then of the greatest job and start position.
    One row per table reaches the driver. ``merges`` names the consolidated tables
    that a table feeds.
    """

    REQUIRED = ("server_host", "port", "database", "table", "identity_key")

    def __init__(self, spark: SparkSession, path: str, root: str = "/user",
                 merges: Callable[[TableRef], list[MergeTarget]] | None = None, versioned: bool = False):
        self.spark, self.path, self.root, self.merges, self.versioned = spark, path, root, merges, versioned

    def __call__(self, batch: DataFrame | None = None, batch_id: int = 0) -> dict[str, TableTarget] | None:
        if batch is None:
            return self.targets()
        requests = decode_requests(batch, "apply")
        missing = F.coalesce(*[F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(f"no {c}")) for c in self.REQUIRED])
        judged = requests.withColumn("reason", missing).withColumn("valid", F.col("reason").isNull())
        judged.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        return None

    def requests(self) -> DataFrame:
        """Every request with its batch; ``reason`` says why one is refused."""
        schema = T.StructType([
            *APPLY_REQUEST.fields, T.StructField("topic_cdc", T.StringType()), T.StructField("reason", T.StringType()),
            T.StructField("valid", T.BooleanType()), T.StructField("batch", T.LongType()),
        ])
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def targets(self) -> dict[str, TableTarget]:
        """The newest request's target per change stream."""
        rank = F.struct("batch", F.coalesce("job_id", F.lit(-1)), F.coalesce("latest_offset", F.lit(-1)))
        accepted = self.requests().where("valid")
        newest = accepted.groupBy("topic_cdc").agg(F.max_by(F.struct(*[c for c in accepted.columns if c != "topic_cdc"]), rank).alias("r"))
        return {row["topic_cdc"]: self._target(row["r"]) for row in newest.collect()}

    def _target(self, r) -> TableTarget:
        dialect = (r["database_type"] or "mysql").lower()
        ref = TableRef(dialect, r["server_host"], r["port"], r["database"], r["table"], r["username"])
        return TableTarget(
            ref.path(self.root), r["identity_key"], r["table"], dialect, r["partition_by"] or "",
            self.merges(ref) if self.merges else [], self.versioned, r["latest_offset"], r["max_retries"],
        )


class QueryRunner:
    """A batch handler for a stream of query requests: runs each, exports its result, appends its outcome."""

    def __init__(self, spark: SparkSession, catalog, out_dir: str, outcomes: str):
        self.spark, self.catalog, self.out_dir, self.outcomes = spark, catalog, out_dir, outcomes

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        requests = decode_requests(batch, "query")
        outcome = run_queries(spark, requests, self.catalog, self.out_dir)
        # One folder per batch: a repeat overwrites its own.
        outcome.coalesce(1).write.mode("overwrite").parquet(f"{self.outcomes}/batch={batch_id}")


class TableMerger:
    """A batch handler for a stream of merge requests: brings each named table copy into its consolidated table.

    ``definitions`` gives a consolidated table's mapping by name, ``alias_of`` the
    alias of a host and port. A failing request fails its batch, which then runs
    again; a member brought in before is refreshed.
    """

    def __init__(self, spark: SparkSession, definitions: dict[str, list[Mapping]], alias_of: Callable[[str, str], str], root: str):
        self.spark, self.definitions, self.alias_of, self.root = spark, definitions, alias_of, root

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for r in decode_requests(batch, "merge").toLocalIterator():
            ref = TableRef(r["databaseType"], r["host"], r["port"], r["database"], r["table"], r["username"])
            path, alias = merge_table_path(r["mergeTable"], self.root), self.alias_of(r["host"], r["port"])
            consolidate_table(
                spark, path, spark.read.parquet(ref.path(self.root)), self.definitions[r["mergeTable"]], ref.table, alias
            )


def stream_run_log(spark: SparkSession, source: str, path: str, checkpoint: str, format: str = "parquet",
                   once: bool = False, **options: str) -> StreamingQuery:
    """Copy step events from a stream of them to a stored run log."""
    events = read_stream(spark, source, format, RUN_LOG, **options)
    writer = events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
