"""Measured sizes that decide how a join is run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Keys are short; this many stay far below what an executor can hold.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024

# As many rows of one key as a single join task takes in its stride.
HEAVY_KEY_ROWS = 100_000


def heaviest_key(df: DataFrame, keys: list[str]) -> int:
    """Rows of the most frequent key, NULL counting as one. Counts per key before it shuffles."""
    counts = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("rows"))
    return counts.agg(F.coalesce(F.max("rows"), F.lit(0)).alias("rows")).first()["rows"]


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, bool]:
    """Mark a stored frame for broadcast if it is measured to be small, and say whether it was.

    For frames read back from a written table, where one more pass over few
    columns costs little. An unmarked frame is joined as Spark finds best: by
    broadcast below its own threshold, else by shuffle, with skewed partitions
    split.
    """
    sizes = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(8)) + 8 for f in df.schema.fields]
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(sum(sizes[1:], sizes[0])), F.lit(0)).alias("bytes")
    ).first()
    small = measured["rows"] <= max_rows and measured["bytes"] <= max_bytes
    return (F.broadcast(df) if small else df), small
