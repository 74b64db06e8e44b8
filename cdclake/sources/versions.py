"""Tables kept as versions: each names its live files and its schema, and takes effect in one step.

A table is a folder of Parquet files, a sub-folder per write, and one small note
per version in ``_versions``. A write adds files, then a note; no file is moved
or changed, so a reader sees the version it opened, whole, whatever is written
meanwhile, and a write that fails leaves files nobody names. Files hold the
columns their version had: a column added later is NULL in them, so it rewrites
nothing. One writer per table.

A note lists all live files, about a hundred bytes each, which the driver needs
anyway to plan a scan. ``remove_unreferenced`` deletes what the last versions do
not name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cdclake.operators.columns import col, resolve
from cdclake.plans.sizing import broadcast_if_small
from cdclake.sources.tables import _fs, _move, _read_text, _write_text, delete, exists, list_names, recover_table

#: Partition column of the folder each write makes; not a column of the table.
COMMIT = "__commit"
#: Files are merged into ones of about this size.
FILE_BYTES = 128 * 1024 * 1024


@dataclass
class Version:
    """One state of a table. ``files`` are the live files, relative to the data folder, and their bytes."""

    number: int
    schema: T.StructType
    partition_by: list[str] = field(default_factory=list)
    files: dict[str, int] = field(default_factory=dict)

    def folder_of(self, file: str) -> str:
        """The partition folder a file lies in; empty without partition columns."""
        return file.split("/", 1)[1].rpartition("/")[0]


def _note(path: str, number: int) -> str:
    return f"{path}/_versions/{number:020d}.json"


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in list_names(spark, f"{path}/_versions") if n.endswith(".json") and n[:-5].isdigit()]


def table_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version by number, or the latest; None for a table without versions."""
    if number is None:
        numbers = version_numbers(spark, path)
        if not numbers:
            return None
        number = max(numbers)
    said = json.loads(_read_text(spark, _note(path, number)))
    return Version(number, T.StructType.fromJson(said["schema"]), said["partition_by"], said["files"])


def read_files(spark: SparkSession, path: str, schema: T.StructType, files: Iterable[str]) -> DataFrame:
    """Rows of some files of a table, under one schema; columns a file lacks are NULL."""
    files = list(files)
    if not files:
        return spark.createDataFrame([], schema)
    full = T.StructType(schema.fields + [T.StructField(COMMIT, T.StringType())])
    found = spark.read.schema(full).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in files])
    return found.select(*[col(n) for n in schema.names])


def read_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """A table by path: its latest version, or the one with this number; a table without versions as plain Parquet."""
    version = table_version(spark, path, number)
    if version is None:
        recover_table(spark, path)
        return spark.read.parquet(path)
    return read_files(spark, path, version.schema, version.files)


def write_files(df: DataFrame, path: str, partition_by: list[str] = ()) -> dict[str, int]:
    """Write rows as new files, which no version names yet; their names and bytes."""
    spark = df.sparkSession
    folder = f"{COMMIT}={uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/data/{folder}")
    return _list_files(spark, f"{path}/data", folder)


def _list_files(spark: SparkSession, root: str, folder: str = "") -> dict[str, int]:
    """All Parquet files below a folder, by path relative to ``root``, and their bytes."""
    fs, start = _fs(spark, f"{root}/{folder}".rstrip("/"))
    if not fs.exists(start):
        return {}
    base = fs.makeQualified(_fs(spark, root)[1]).toUri().getPath().rstrip("/") + "/"
    found, entries = {}, fs.listFiles(start, True)
    while entries.hasNext():
        entry = entries.next()
        name = entry.getPath().toUri().getPath()
        if name.endswith(".parquet"):
            found[name.removeprefix(base)] = entry.getLen()
    return found


def commit(
    spark: SparkSession, path: str, before: Version | None, schema: T.StructType, partition_by: Iterable[str],
    removed: Iterable[str], added: dict[str, int],
) -> Version:
    """Make the next version: its note appears under its name complete or not at all.

    A version that another writer has made meanwhile is an error, and nothing is changed.
    """
    gone = set(removed)
    files = {f: n for f, n in (before.files if before else {}).items() if f not in gone} | added
    version = Version(before.number + 1 if before else 1, schema, list(partition_by), files)
    draft, note = f"{path}/_versions/.{uuid.uuid4().hex}", _note(path, version.number)
    _write_text(spark, draft, json.dumps({"schema": schema.jsonValue(), "partition_by": version.partition_by, "files": files}))
    if exists(spark, note):
        delete(spark, draft)
        raise RuntimeError(f"version {version.number} of {path} was made by another writer")
    _move(spark, draft, note)
    return version


def start_versions(df: DataFrame, path: str, partition_by: str | Iterable[str] = (), number: Version | None = None) -> Version:
    """Write a frame as the first version of a table, or as the whole of the next one after ``number``."""
    columns = resolve(df, partition_by)
    laid_out = df.hint("rebalance", *[col(c) for c in columns]) if columns else df
    return commit(
        df.sparkSession, path, number, df.schema, columns, number.files if number else (), write_files(laid_out, path, columns)
    )


def file_name() -> Column:
    """The file a row is read from, as versions name it."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(decoded, f"({COMMIT}=.*)$", 1)


def hit_files(rows: DataFrame, keys: DataFrame, condition: Column) -> list[str]:
    """Files with a row that meets one of ``keys``; the scan reads the columns of the condition alone.

    ``rows`` come from ``read_files`` and have the columns that the condition
    names. At most one row per file reaches the driver, which knows the files.
    """
    located = rows.join(keys, condition, "left_semi").select("_file").distinct()
    return sorted(r["_file"] for r in located.collect())


def pack_files(sizes: dict[str, int], most: int) -> list[list[str]]:
    """Files in groups of at most ``most`` bytes, the largest first into the first group with room; groups of one are left out."""
    groups: list[list] = []
    for file, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        for group in groups:
            if group[0] + size <= most:
                group[0] += size
                group[1].append(file)
                break
        else:
            groups.append([size, [file]])
    return [files for _, files in groups if len(files) > 1]


def merge_small_files(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> Version | None:
    """Rewrite the small files of each partition into ones of about ``file_bytes``; the new version, None if there is nothing to do.

    Each group of files is written by one task, which its bytes bound.
    """
    version = table_version(spark, path)
    by_folder: dict[str, dict[str, int]] = {}
    for file, size in (version.files if version else {}).items():
        if 2 * size < file_bytes:
            by_folder.setdefault(version.folder_of(file), {})[file] = size
    groups = [files for sizes in by_folder.values() for files in pack_files(sizes, file_bytes)]
    if not groups:
        return None
    listed = [(file, number) for number, files in enumerate(groups) for file in files]
    group_of, _ = broadcast_if_small(spark.createDataFrame(listed, "_file string, _group int"))
    full = T.StructType(version.schema.fields + [T.StructField(COMMIT, T.StringType())])
    source = spark.read.schema(full).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f, _ in listed])
    rows = source.select(*[col(n) for n in version.schema.names], file_name().alias("_file")).join(group_of, "_file")
    packed = rows.repartition(len(groups), "_group").select(*[col(n) for n in version.schema.names])
    added = write_files(packed, path, version.partition_by)
    return commit(spark, path, version, version.schema, version.partition_by, [f for f, _ in listed], added)


def small_files(version: Version, file_bytes: int = FILE_BYTES) -> int:
    """The most small files in one partition folder."""
    counts: dict[str, int] = {}
    for file, size in version.files.items():
        if 2 * size < file_bytes:
            folder = version.folder_of(file)
            counts[folder] = counts.get(folder, 0) + 1
    return max(counts.values(), default=0)


def remove_unreferenced(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete notes but the last ``keep``, and files that none of those names; how many files went.

    Readers of older versions, and a write that is under way, lose their files,
    so it belongs where neither is.
    """
    numbers = sorted(version_numbers(spark, path))
    live = {f for n in numbers[-keep:] for f in table_version(spark, path, n).files}
    gone = [f for f in _list_files(spark, f"{path}/data") if f not in live]
    for number in numbers[:-keep]:
        delete(spark, _note(path, number))
    for file in gone:
        delete(spark, f"{path}/data/{file}")
    return len(gone)


def history(spark: SparkSession, path: str) -> list[Version]:
    """All versions that still have their note: the schema of each, and its files."""
    return [table_version(spark, path, n) for n in sorted(version_numbers(spark, path))]


__all__ = [
    "Version", "commit", "history", "hit_files", "merge_small_files", "read_files", "read_table", "remove_unreferenced",
    "start_versions", "table_version", "write_files",
]
