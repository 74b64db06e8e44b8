"""Consolidated tables that record which members feed a row, and with which values.

The record is a column ``_fed``: an array with one struct per member that feeds
the row, the last one brought in first, holding the member's name and its values
of the mapped columns that are not unique. A mapped column shows the first value
of the record that is not NULL. So when a member drops a row, its values give way
to those of the other members, and a row that no member feeds goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cdclake.model import DELETE, Mapping
from cdclake.operators.align import align_schemas
from cdclake.operators.columns import col
from cdclake.operators.consolidate import consolidate, keys_match
from cdclake.plans.sizing import broadcast_if_small

FED = "_fed"
_NEW, _OLD = "_fed_new", "_fed_old"


def member_name(table: str, alias: str) -> str:
    """A member's name in the record; also what its own columns end in."""
    return f"{table.replace('.', '_')}_{alias}"


def _values(columns, mapping: list[Mapping]) -> list[str]:
    """The columns whose values the record holds."""
    shared = {m.column.lower() for m in mapping if not m.unique} - {m.column.lower() for m in mapping if m.unique}
    return [c for c in columns if c.lower() in shared]


def with_member(rows: DataFrame, mapping: list[Mapping], table: str, alias: str) -> DataFrame:
    """A member's rows, under consolidated names, with the record of it as the only one that feeds them."""
    entry = F.struct(F.lit(member_name(table, alias)).alias("member"), *[col(c) for c in _values(rows.columns, mapping)])
    return rows.withColumn(FED, F.array(entry))


def refresh_member(
    merged: DataFrame | None,
    new: DataFrame,
    mapping: list[Mapping],
    table: str,
    alias: str,
    on_conflict: str = "string",
    measure: bool = False,
    refuse_repeats: bool = False,
) -> DataFrame:
    """Bring a member's rows, under consolidated names, into a consolidated table with a record.

    Whether the member was brought in before or not, afterwards it feeds the rows
    that ``new`` matches and no others. Rows that nobody feeds any more are gone.
    A column that ``new`` does not carry keeps its values. Unique columns are
    equal in all members of a row and stay. NULL keys match nothing.

    The join is that of ``consolidate``, with its ways for small members and hot keys.
    """
    new = with_member(new, mapping, table, alias)
    if merged is None:
        return new
    if FED not in merged.columns:
        raise ValueError(f"the consolidated table has no record of its members ({FED})")
    name = member_name(table, alias)
    mapped = {m.column.lower() for m in mapping}
    replaced = {c.lower() for c in new.columns if c.lower() not in mapped}
    before = merged.select(
        *[col(c) for c in merged.columns if c.lower() not in replaced],
        F.filter(FED, lambda e: e["member"] != name).alias(FED),
        F.get(F.filter(FED, lambda e: e["member"] == name), F.lit(0)).alias(_OLD),
    )
    joined = consolidate(
        before, new.withColumnRenamed(FED, _NEW), mapping, on_conflict, measure=measure, refuse_repeats=refuse_repeats
    )

    kinds = {f.name: f.dataType for f in joined.schema.fields}
    values = _values(joined.columns, mapping)
    carried = {c.lower() for c in new.columns}
    held = {f.name.lower(): f.name for f in merged.schema[FED].dataType.elementType.fields}
    spelled = {c.lower(): c for c in new.columns}

    def entry(e: Column, own: bool) -> Column:
        fields = []
        for c in values:
            if own and c.lower() in carried:
                value = e[spelled[c.lower()]]
            elif c.lower() not in held:
                value = F.lit(None)
            else:
                value = (F.col(_OLD) if own else e)[held[c.lower()]]
            fields.append(value.cast(kinds[c]).alias(c))
        return F.struct(e["member"].alias("member"), *fields)

    entries = F.array(F.transform(_NEW, lambda e: entry(e, True)), F.transform(FED, lambda e: entry(e, False)))
    recorded = joined.withColumn(FED, F.flatten(F.array_compact(entries))).where(F.size(FED) > 0)

    def shown(c: str) -> Column:
        given = F.filter(F.transform(FED, lambda e: e[c]), lambda v: v.isNotNull())
        return F.get(given, F.lit(0)).alias(c)

    plain = [c for c in recorded.columns if c not in (FED, _NEW, _OLD)]
    return recorded.select(*[shown(c) if c in values else col(c) for c in plain], FED)


def propagate_member(
    merged: DataFrame,
    delta: DataFrame,
    keys: list[str],
    mapping: list[Mapping],
    table: str,
    alias: str,
    seq: str = "seq",
    op: str = "operation",
    on_conflict: str = "string",
    measure: bool = False,
) -> DataFrame:
    """A consolidated table with a record after changes to one member, under consolidated names.

    Only rows of a changed key take part in the join; the others pass by. NULL
    counts as one key here, as in the other modes of ``propagate_changes``.
    """
    changed = delta.select(*[col(k) for k in keys]).distinct()
    if measure:
        changed, _ = broadcast_if_small(changed)
    match = keys_match(merged, changed, keys)
    touched, rest = merged.join(changed, match, "left_semi"), merged.join(changed, match, "left_anti")
    written = delta.where(F.coalesce(col(op), F.lit(0)) != DELETE).drop(op, seq)
    after = refresh_member(touched, written, mapping, table, alias, on_conflict, measure)
    kinds = after.schema[FED].dataType.elementType
    held = {f.name for f in merged.schema[FED].dataType.elementType.fields}
    record = F.transform(FED, lambda e: F.struct(*[
        (e[f.name] if f.name in held else F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds.fields
    ]))
    a, b = align_schemas(rest.drop(FED), after.drop(FED), on_conflict)
    a = rest.select(*_as_aligned(rest, a), record.alias(FED))
    b = after.select(*_as_aligned(after, b), FED)
    return a.unionByName(b)


def _as_aligned(df: DataFrame, aligned: DataFrame) -> list[Column]:
    spelled = {c.lower(): c for c in df.columns}
    return [
        (col(spelled[f.name.lower()]) if f.name.lower() in spelled else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in aligned.schema.fields
    ]
