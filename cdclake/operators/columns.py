"""Column-list helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def col(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_list(names: str | Iterable[str]) -> list[str]:
    """Column names from a list or from comma-separated text; blank text means none."""
    if isinstance(names, str):
        names = names.split(",")
    return [n.strip() for n in names if n.strip()]


def resolve(df: DataFrame, names: str | Iterable[str]) -> list[str]:
    """The frame's own spelling of ``names``, matched without case."""
    spelled = {c.lower(): c for c in df.columns}
    wanted = as_list(names)
    missing = [n for n in wanted if n.lower() not in spelled]
    if missing:
        raise ValueError(f"no column {missing} among {df.columns}")
    return [spelled[n.lower()] for n in wanted]


def same_values(left: DataFrame, right: DataFrame, names: Iterable[str], null_safe: bool = True) -> Column:
    """Join condition: equal values in all the named columns."""
    condition = F.lit(True)
    for name in names:
        a, b = left[f"`{name}`"], right[f"`{name}`"]
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return condition


def any_null(names: Iterable[str]) -> Column:
    condition = F.lit(False)
    for name in names:
        condition = condition | col(name).isNull()
    return condition
