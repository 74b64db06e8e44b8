"""Reduce a change log to the events that still matter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from cdclake.model import DELETE, INSERT, UPDATE
from cdclake.operators.columns import any_null, col, resolve


def compact_changes(
    changes: DataFrame,
    key: str | Iterable[str],
    seq: str = "seq",
    op: str = "operation",
    mode: str = "per_operation",
) -> DataFrame:
    """Keep the last events of every key.

    ``latest`` keeps one row per key, its newest event.

    ``per_operation`` keeps at most one row per key and operation: events before
    the key's last delete go, then inserts before its last remaining update,
    then all but the newest of each operation. A NULL key equals no key in the
    first two steps, but counts as one group in the last.

    Both modes are a single aggregate. What each step keeps depends only on the
    newest event per key and operation, so the newest ones are found first, with
    a partial aggregate ahead of the shuffle, and the rules are applied to those
    three rows. A key that owns a large share of the log reaches the shuffle as
    one row per map task.

    Operations other than insert, update and delete are not expected here;
    ``decode_changes`` sets such events aside.
    """
    keys = resolve(changes, key)
    if not keys:
        raise ValueError("compaction needs a key")
    rest = [c for c in changes.columns if c not in keys]
    row = F.struct(*[col(c) for c in rest])
    if mode == "latest":
        newest = changes.groupBy(*[col(k) for k in keys]).agg(F.max_by(row, col(seq)).alias("_row"))
        return newest.select(*[_field(c, keys) for c in changes.columns])
    if mode != "per_operation":
        raise ValueError(f"unknown mode {mode!r}")

    def newest_of(operation: int):
        wanted = col(op) == operation
        return F.max_by(row, F.when(wanted, col(seq)))

    per_key = changes.groupBy(*[col(k) for k in keys]).agg(
        newest_of(INSERT).alias("_insert"), newest_of(UPDATE).alias("_update"), newest_of(DELETE).alias("_delete")
    )
    no_key = any_null(keys)
    inserted, updated, deleted = (F.col(c)[seq] for c in ("_insert", "_update", "_delete"))
    update_stays = updated.isNotNull() & (deleted.isNull() | no_key | (updated >= deleted))
    insert_stays = (
        inserted.isNotNull()
        & (deleted.isNull() | no_key | (inserted >= deleted))
        & (~update_stays | no_key | (inserted > updated))
    )
    kept = F.array(
        F.col("_delete"), F.when(update_stays, F.col("_update")), F.when(insert_stays, F.col("_insert"))
    )
    rows = per_key.select(*[col(k) for k in keys], F.explode(kept).alias("_row")).where("_row is not null")
    return rows.select(*[_field(c, keys) for c in changes.columns])


def _field(name: str, keys: list[str]):
    return col(name) if name in keys else F.col("_row")[name].alias(name)
