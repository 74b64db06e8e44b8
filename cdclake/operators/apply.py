"""Merge a batch of changes into a table copy."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cdclake.model import DELETE
from cdclake.operators.align import align_schemas
from cdclake.operators.columns import any_null, as_list, col, resolve
from cdclake.operators.compact import compact_changes
from cdclake.plans.sizing import broadcast_if_small
from cdclake.session import work_path
from cdclake.sources.tables import delete, exists, list_names, partition_folders, publish, recover_table, replace_table, staging_path, write_table


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    key: str | Iterable[str],
    compact: str | None = "latest",
    seq: str = "seq",
    op: str = "operation",
    on_conflict: str = "string",
    measure: bool = False,
) -> DataFrame:
    """The table after a batch of changes.

    Rows whose key was deleted or written again leave; the written rows enter
    whole, so a table column the changes do not carry becomes NULL in them.
    Rows of other keys stay, duplicates included. NULL keys: a written row
    replaces rows with a NULL key, a delete without a key removes nothing.

    The table is filtered by an anti-join with the changed keys and is not
    shuffled when those are few. No window or aggregate runs over the table.
    Spark's size estimate decides what few is; for a stored, compacted delta
    (``compact=None``), ``measure=True`` counts its keys instead.
    """
    key = as_list(key)
    delta = changes if compact is None else compact_changes(changes, key, seq, op, compact)
    keys = changed_keys(delta, key, op)
    if measure:
        keys, _ = broadcast_if_small(keys)
    old, new = align_schemas(target, written_rows(delta, seq, op), on_conflict)
    return _without(old, keys, key).unionByName(new)


def written_rows(delta: DataFrame, seq: str, op: str) -> DataFrame:
    return delta.where(col(op) != DELETE).drop(op, seq)


def changed_keys(delta: DataFrame, key: list[str], op: str) -> DataFrame:
    """Keys whose table rows a delta displaces."""
    names = resolve(delta, key)
    return delta.where((col(op) != DELETE) | ~any_null(names)).select(*[col(n) for n in names])


def _without(target: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    return target.join(keys, _key_match(target, keys, key), "left_anti")


def _key_match(target: DataFrame, keys: DataFrame, key: list[str]):
    condition = F.lit(True)
    for t, k in zip(resolve(target, key), resolve(keys, key)):
        left, right = target[f"`{t}`"], keys[f"`{k}`"]
        if target.schema[t].dataType != keys.schema[k].dataType and "string" in (
            target.schema[t].dataType.simpleString(), keys.schema[k].dataType.simpleString()
        ):
            # Compared as the text they are stored as after a type conflict.
            left, right = left.cast("string"), right.cast("string")
        condition = condition & left.eqNullSafe(right)
    return condition


def stage_delta(
    changes: DataFrame, key: str | Iterable[str], compact: str = "latest", seq: str = "seq", op: str = "operation"
) -> tuple[DataFrame, str]:
    """Compact a batch once and store it in the shared folder; the stored rows and their path.

    The merge needs the delta several times. Stored, it is decoded and shuffled
    once, its size is known, and a lost executor costs no recomputation of the
    log.
    """
    spark = changes.sparkSession
    path = work_path(spark, "delta")
    compacted = compact_changes(changes, key, seq, op, compact)
    compacted.write.parquet(path)
    return spark.read.schema(compacted.schema).parquet(path), path


def apply_to_table(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    key: str | Iterable[str],
    compact: str = "latest",
    seq: str = "seq",
    op: str = "operation",
    on_conflict: str = "string",
) -> DataFrame:
    """Apply a batch to a stored, unpartitioned table and replace it; the new table."""
    delta, staged = stage_delta(changes, key, compact, seq, op)
    try:
        return merge_delta(spark, path, delta, key, (), seq, op, on_conflict)
    finally:
        delete(spark, staged)


def apply_changes_partitioned(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    key: str | Iterable[str],
    partition_by: str | Iterable[str],
    compact: str = "latest",
    seq: str = "seq",
    op: str = "operation",
    on_conflict: str = "string",
) -> DataFrame:
    """Apply a batch to a stored, partitioned table, writing only the partitions it concerns; the new table.

    Partitions holding a row of a changed key are found by key, so a row that
    moves to another partition leaves its old one, and are rewritten without
    those rows. A partition left empty is removed. Written rows for other
    partitions are added to them as new files. The result equals
    ``apply_changes``, and repeating a batch changes nothing.

    New columns or changed types concern every file, so such a batch rewrites
    the whole table once.
    """
    if not as_list(partition_by):
        raise ValueError("a partitioned merge needs partition columns")
    delta, staged = stage_delta(changes, key, compact, seq, op)
    try:
        return merge_delta(spark, path, delta, key, partition_by, seq, op, on_conflict)
    finally:
        delete(spark, staged)


def merge_delta(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    key: str | Iterable[str],
    partition_by: str | Iterable[str] = (),
    seq: str = "seq",
    op: str = "operation",
    on_conflict: str = "string",
) -> DataFrame:
    """Merge a stored delta into a stored table; the new table.

    The changed keys are measured, and broadcast when small: then no table row
    is shuffled, and rows stay in the files of their partition. Otherwise the
    anti-join shuffles, adaptive execution splits skewed partitions, and the
    output is rebalanced on its partition columns.
    """
    key, parts = as_list(key), as_list(partition_by)
    recover_table(spark, path)
    keys, few = broadcast_if_small(changed_keys(delta, key, op))
    target = _read_table(spark, path, parts, delta, seq, op)
    parts = resolve(target, parts)
    old, new = align_schemas(target, written_rows(delta, seq, op), on_conflict)
    if not parts:
        replace_table(_without(old, keys, key).unionByName(new), path)
        return spark.read.schema(old.schema).parquet(path)

    def output(kept: DataFrame | None) -> DataFrame:
        by = [col(p) for p in parts]
        if kept is None:
            return new.hint("rebalance", *by)
        return kept.unionByName(new.hint("rebalance", *by)) if few else kept.unionByName(new).hint("rebalance", *by)

    if _shape(old) != _shape(target):
        replace_table(output(_without(old, keys, key)), path, parts, rebalance=False)
        return spark.read.schema(old.schema).option("basePath", path).parquet(path)
    rewritten = _touched_folders(target, keys, key, parts) if _has_partitions(spark, path) else []
    kept = None
    if rewritten:
        touched = spark.read.schema(target.schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in rewritten])
        kept = _without(touched, keys, key).select(*[col(c) for c in new.columns])
    stage = staging_path(path)
    write_table(output(kept), stage, parts, rebalance=False)
    written = partition_folders(spark, stage, len(parts))
    actions = {f: "remove" for f in rewritten if f not in written}
    actions |= {f: "replace" if f in rewritten else "append" for f in written}
    publish(spark, stage, path, actions)
    return spark.read.schema(old.schema).option("basePath", path).parquet(path)


def _shape(df: DataFrame) -> list[tuple]:
    return [(f.name, f.dataType) for f in df.schema.fields]


def _read_table(spark: SparkSession, path: str, parts: list[str], delta: DataFrame, seq: str, op: str) -> DataFrame:
    """The stored table. Partition values, stored as text, get the type the delta has for them.

    Left to inference, a text value such as ``007`` would come back as a number
    and be written as another partition.
    """
    if not parts:
        if not exists(spark, path):
            # The first batch of a table without a copy starts it.
            return spark.createDataFrame([], delta.schema).drop(op, seq)
        return spark.read.parquet(path)
    if not _has_partitions(spark, path):
        # No partition is left, and with it no file that tells the columns.
        return spark.createDataFrame([], delta.schema).drop(op, seq)
    found = spark.read.parquet(path)
    names = {p.lower() for p in parts}
    types = {f.name.lower(): f.dataType for f in delta.schema.fields}
    schema = T.StructType([
        T.StructField(f.name, types.get(f.name.lower(), T.StringType()) if f.name.lower() in names else f.dataType)
        for f in found.schema.fields
    ])
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def _has_partitions(spark: SparkSession, path: str) -> bool:
    return any("=" in name for name in list_names(spark, path))


def _touched_folders(target: DataFrame, keys: DataFrame, key: list[str], parts: list[str]) -> list[str]:
    """Partition folders holding a row of a changed key. Reads the key columns only.

    The range of the changed keys goes into the scan, where the statistics in
    the files can rule out row groups. At most one row per partition of the
    table reaches the driver, which lists those folders anyway.
    """
    names = resolve(target, key)
    target = target.where(_within_range(target, keys, key))
    located = target.select(*[col(n) for n in names], F.col("_metadata.file_path").alias("_file"))
    hits = located.join(keys, _key_match(located, keys, key), "left_semi").select("_file").distinct()
    folders = hits.select(folder_of("_file", len(parts)).alias("_folder")).distinct()
    return sorted(r["_folder"].rstrip("/") for r in folders.collect())


def _within_range(target: DataFrame, keys: DataFrame, key: list[str]) -> Column:
    """Whether a row's first key column lies between the least and greatest changed key."""
    name, changed = resolve(target, key)[0], resolve(keys, key)[0]
    kind = target.schema[name].dataType
    if kind != keys.schema[changed].dataType or not isinstance(kind, (T.IntegralType, T.StringType, T.DateType)):
        return F.lit(True)
    bounds = keys.agg(
        F.min(col(changed)).alias("low"), F.max(col(changed)).alias("high"), F.count_if(col(changed).isNull()).alias("nulls")
    ).first()
    within = col(name).between(F.lit(bounds["low"]).cast(kind), F.lit(bounds["high"]).cast(kind))
    return within | col(name).isNull() if bounds["nulls"] else within


def folder_of(file: str, depth: int) -> Column:
    """The partition folder in a file path, which comes percent-encoded; a plus sign in one means itself."""
    decoded = F.url_decode(F.replace(F.col(file), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(decoded, "((?:[^/]+=[^/]*/){%d})[^/]+$" % depth, 1)
