"""Parquet tables: writing, replacing one that is also being read, exporting."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from cdclake.operators.columns import as_list, col

_PLAN = "_publish.json"


def write_table(
    df: DataFrame, path: str, partition_by: str | Iterable[str] = (), mode: str = "overwrite", rebalance: bool = True
) -> None:
    """Write a frame as a Parquet table.

    Partitioned output is rebalanced on its partition columns first, so a table
    does not end up with one small file per task and partition; adaptive
    execution splits a partition value that holds a large share of the rows.
    ``rebalance=False`` spares the shuffle where the frame is laid out already.
    """
    columns = as_list(partition_by)
    if columns and rebalance:
        df = df.hint("rebalance", *[col(c) for c in columns])
    df.write.mode(mode).partitionBy(*columns).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: str | Iterable[str] = (), rebalance: bool = True) -> None:
    """Replace a table with a frame that may read that same table.

    The frame is written next to the table and then takes its place. Once the
    staged copy is complete a failure at any point loses nothing: the next call,
    or ``recover_table``, finishes the exchange. One writer per table.
    """
    spark = df.sparkSession
    recover_table(spark, path)
    stage = staging_path(path)
    write_table(df, stage, partition_by, rebalance=rebalance)
    publish(spark, stage, path)


def staging_path(path: str) -> str:
    """A fresh path on the table's own file system, where moving into place is cheap."""
    return _beside(path, f"staging-{uuid.uuid4().hex}")


def publish(spark: SparkSession, stage: str, path: str, partitions: dict[str, str] | None = None) -> None:
    """Bring a staged table, or staged partitions of one, into place.

    ``partitions`` names what happens to each partition folder: ``replace`` it,
    ``append`` the staged files to it, or ``remove`` it. Without it the whole
    table is replaced.
    """
    pending = _beside(path, "pending")
    _write_text(spark, f"{stage}/{_PLAN}", json.dumps(partitions))
    # From here on the change is decided; everything after can be repeated.
    _move(spark, stage, pending)
    recover_table(spark, path)


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish an exchange that a failure cut short; nothing to do otherwise."""
    pending = _beside(path, "pending")
    if not exists(spark, f"{pending}/{_PLAN}"):
        return
    partitions = json.loads(_read_text(spark, f"{pending}/{_PLAN}"))
    if partitions is None:
        delete(spark, path)
        _move(spark, pending, path)
        delete(spark, f"{path}/{_PLAN}")
        return
    for folder, action in partitions.items():
        target, staged = f"{path}/{folder}", f"{pending}/{folder}"
        if action == "remove":
            delete(spark, target)
        elif exists(spark, staged) and (action == "replace" or not exists(spark, target)):
            delete(spark, target)
            _move(spark, staged, target)
        elif exists(spark, staged):
            for name in list_names(spark, staged):
                _move(spark, f"{staged}/{name}", f"{target}/{name}")
    delete(spark, pending)


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative partition folders of a table, ``depth`` levels down."""
    folders = [""]
    for _ in range(depth):
        folders = [
            f"{parent}/{name}".lstrip("/")
            for parent in folders
            for name in list_names(spark, f"{path}/{parent}".rstrip("/"))
            if "=" in name and not name.startswith(("_", "."))
        ]
    return folders


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Write a result as CSV with a header row; the path of the file, or of the folder.

    One file means one writing task, so it is for results known to be small.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    if not single_file:
        return path
    names = [n for n in list_names(df.sparkSession, path) if not n.startswith(("_", "."))]
    return f"{path}/{names[0]}" if names else path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _beside(path: str, name: str) -> str:
    parent, _, last = path.rstrip("/").rpartition("/")
    # The leading underscore hides it from readers of the parent folder.
    return f"{parent}/_{last}.{name}"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
