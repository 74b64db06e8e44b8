"""Merging changes into tables kept as versions: only files that hold a changed key are written anew."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cdclake.model import DELETE, MODIFIED, Mapping
from cdclake.operators.align import align_schemas
from cdclake.operators.apply import _key_match, _within_range, _without, changed_keys, stage_delta, written_rows
from cdclake.operators.columns import as_list, col, resolve
from cdclake.operators.consolidate import _has, mapped_names, propagate_changes
from cdclake.operators.members import with_member
from cdclake.plans.sizing import broadcast_if_small
from cdclake.sources.tables import delete
from cdclake.sources.versions import (
    COMMIT, FILE_BYTES, Version, commit, file_name, hit_files, merge_small_files, read_files, small_files, table_version, write_files,
)

#: Small files in a partition beyond which a merge packs them together.
SMALL_FILES = 32


def apply_to_versions(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    key: str | Iterable[str],
    partition_by: str | Iterable[str] = (),
    compact: str = "latest",
    seq: str = "seq",
    op: str = "operation",
    on_conflict: str = "string",
    most_small_files: int | None = SMALL_FILES,
) -> DataFrame:
    """Apply a batch to a table kept as versions; the new table. Rows equal those of ``apply_changes``."""
    delta, staged = stage_delta(changes, key, compact, seq, op)
    try:
        return merge_versions(spark, path, delta, key, partition_by, seq, op, on_conflict, most_small_files)
    finally:
        delete(spark, staged)


def merge_versions(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    key: str | Iterable[str],
    partition_by: str | Iterable[str] = (),
    seq: str = "seq",
    op: str = "operation",
    on_conflict: str = "string",
    most_small_files: int | None = SMALL_FILES,
) -> DataFrame:
    """Merge a stored, compacted delta into a table kept as versions; the new table.

    Files with a row of a changed key are found by reading the key columns alone,
    and written anew without those rows; the written rows go into new files. A
    new column enters the schema and rewrites nothing; only a column whose type
    changes rewrites the table. The first batch of an absent table starts it.
    """
    key = as_list(key)
    version = table_version(spark, path)
    new = written_rows(delta, seq, op)
    if version is None:
        version = commit(spark, path, None, new.schema, resolve(new, partition_by), (), {})
    keys, few = broadcast_if_small(changed_keys(delta, key, op))
    target = read_files(spark, path, version.schema, version.files)
    old, new = align_schemas(target, new, on_conflict)
    schema = _nullable(old.schema)
    if _retyped(version.schema, schema):
        hits, kept = list(version.files), _without(old, keys, key)
    else:
        hits = _files_of(spark, path, version, keys, key)
        kept = _without(read_files(spark, path, schema, hits), keys, key)
    version = _replace_files(spark, path, version, schema, hits, kept, new, few)
    if most_small_files is not None and small_files(version) > most_small_files:
        version = merge_small_files(spark, path) or version
    return read_files(spark, path, version.schema, version.files)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def _retyped(before: T.StructType, after: T.StructType) -> bool:
    kinds = {f.name: f.dataType for f in after.fields}
    return any(kinds[f.name] != f.dataType for f in before.fields)


def _files_of(spark: SparkSession, path: str, version: Version, keys: DataFrame, key: list[str]) -> list[str]:
    """Live files with a row of one of the keys, whose range goes into the scan."""
    if not version.files:
        return []
    full = T.StructType(version.schema.fields + [T.StructField(COMMIT, T.StringType())])
    source = spark.read.schema(full).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in version.files])
    names = resolve(source, key)
    rows = source.where(_within_range(source, keys, key)).select(*[col(n) for n in names], file_name().alias("_file"))
    return hit_files(rows, keys, _key_match(rows, keys, key))


def _replace_files(
    spark: SparkSession, path: str, version: Version, schema: T.StructType, hits: list[str], kept: DataFrame, new: DataFrame, few: bool
) -> Version:
    """The version in which ``kept`` and ``new`` stand for the rows of ``hits``."""
    by = [col(p) for p in version.partition_by]
    new = new.select(*[col(c).cast(schema[c].dataType).alias(c) for c in schema.names])
    kept = kept.select(*[col(c) for c in schema.names])
    # Kept rows that were not shuffled lie as in their files; else all are laid out anew.
    out = kept.unionByName(new.hint("rebalance", *by)) if few or not by else kept.unionByName(new).hint("rebalance", *by)
    return commit(spark, path, version, schema, version.partition_by, hits, write_files(out, path, version.partition_by))


def with_before_images(
    delta: DataFrame, copy: DataFrame, key: str | Iterable[str], mapping: list[Mapping], table: str, alias: str,
    seq: str = "seq", op: str = "operation",
) -> DataFrame:
    """A member's delta, and a delete for each value of its unique columns that the changes do away with.

    ``copy`` is the member's copy before the delta is merged: its rows of the
    changed keys hold the old values. A value that the delta writes again is no
    loss. A NULL in a unique column matches nothing, so it needs no delete. Where
    the unique columns are those of the key, they cannot change.
    """
    key = as_list(key)
    names = mapped_names([c for c in delta.columns if c.lower() != MODIFIED], mapping, table, alias, keep=(op.lower(), seq.lower()))
    unique = {m.column.lower() for m in mapping if m.unique}
    columns = [c for c, n in names.items() if n.lower() in unique and _has(copy, c)]
    if not columns or {c.lower() for c in columns} <= {k.lower() for k in key}:
        return delta
    keys, _ = broadcast_if_small(changed_keys(delta, key, op))
    at = resolve(copy, columns)
    # The copy's own type may be text after a type conflict.
    held = copy.join(keys, _key_match(copy, keys, key), "left_semi").select(
        *[col(a).cast(delta.schema[c].dataType).alias(c) for a, c in zip(at, columns)]
    ).dropna().distinct()
    written = written_rows(delta, seq, op).select(*[col(c) for c in columns]).dropna().distinct()
    gone = held.join(written, columns, "left_anti")
    # Before every real change, so that in a compaction by these columns a real one wins.
    return delta.unionByName(
        gone.withColumns({op: F.lit(DELETE).cast(delta.schema[op].dataType), seq: F.lit(-1).cast(delta.schema[seq].dataType)}),
        allowMissingColumns=True,
    )


def propagate_versions(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    mapping: list[Mapping],
    table: str,
    alias: str,
    mode: str = "replace",
    partition_by: str | Iterable[str] = (),
    seq: str = "seq",
    op: str = "operation",
    on_conflict: str = "string",
    most_small_files: int | None = SMALL_FILES,
) -> DataFrame:
    """Pass a member's stored delta on to a consolidated table kept as versions; the new table.

    Only files with a row of a changed unique value are written anew. An absent
    table is started by the rows the delta writes.
    """
    version = table_version(spark, path)
    columns = [c for c in delta.columns if c.lower() != MODIFIED]
    names = mapped_names(columns, mapping, table, alias, keep=(op.lower(), seq.lower()))
    if version is None:
        first = written_rows(delta, seq, op)
        first = first.select(*[col(c).alias(names[c]) for c in first.columns if c in names])
        if mode == "members":
            first = with_member(first, mapping, table, alias)
        version = commit(spark, path, None, _nullable(first.schema), resolve(first, partition_by), (), {})
    unique = [m.column for m in mapping if m.unique and m.column in names.values() and m.column.lower() in {n.lower() for n in version.schema.names}]
    if not unique:
        raise ValueError("no unique mapped column is present on both sides")
    member = {n: c for c, n in names.items()}
    keys, few = broadcast_if_small(delta.select(*[col(member[u]).alias(u) for u in unique]).distinct())
    hits = _files_of(spark, path, version, keys, unique)
    part = read_files(spark, path, version.schema, hits)
    merged = propagate_changes(part, delta, mapping, table, alias, mode, seq=seq, op=op, on_conflict=on_conflict, measure=True)
    if _retyped(version.schema, merged.schema):
        hits = list(version.files)
        part = read_files(spark, path, version.schema, hits)
        merged = propagate_changes(part, delta, mapping, table, alias, mode, seq=seq, op=op, on_conflict=on_conflict, measure=True)
    schema = _nullable(merged.schema)
    by = [col(p) for p in version.partition_by]
    laid_out = merged.select(*[col(c) for c in schema.names]).hint("rebalance", *by) if by else merged
    version = commit(spark, path, version, schema, version.partition_by, hits, write_files(laid_out, path, version.partition_by))
    if most_small_files is not None and small_files(version) > most_small_files:
        version = merge_small_files(spark, path) or version
    return read_files(spark, path, version.schema, version.files)


__all__ = ["FILE_BYTES", "apply_to_versions", "merge_versions", "propagate_versions", "with_before_images"]
