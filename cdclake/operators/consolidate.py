"""Consolidated tables: several member tables joined into one by column mapping."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from cdclake.model import DELETE, MODIFIED, Mapping
from cdclake.operators.align import align_schemas
from cdclake.operators.columns import col, resolve
from cdclake.operators.compact import compact_changes
from cdclake.plans.sizing import HEAVY_KEY_ROWS, broadcast_if_small, heaviest_key


def mapped_names(columns: Iterable[str], mapping: list[Mapping], table: str, alias: str, keep=("operation",)) -> dict[str, str]:
    """Consolidated name of every member column.

    A column named in the mapping takes the mapping's name; any other is
    suffixed with table and alias. A mapping without its column is skipped, and
    the first mapping of a column wins.
    """
    prefix = f"{alias}.{table}.".lower()
    targets: dict[str, str] = {}
    for m in mapping:
        for source in m.sources:
            if source.lower().startswith(prefix):
                targets.setdefault(source[len(prefix):].lower(), m.column)
    suffix = f"{table.replace('.', '_')}_{alias}"
    names = {}
    for c in columns:
        if c.lower() in keep:
            names[c] = c
        else:
            names[c] = targets.get(c.lower(), f"{c.lower()}_{suffix}")
    if len({n.lower() for n in names.values()}) < len(names):
        raise ValueError(f"two columns of {alias}.{table} map to one name: {names}")
    return names


def map_columns(df: DataFrame, mapping: list[Mapping], table: str, alias: str, keep=("operation",)) -> DataFrame:
    """A member table with its consolidated column names."""
    names = mapped_names(df.columns, mapping, table, alias, keep)
    return df.select(*[col(c).alias(n) for c, n in names.items()])


def unique_columns(mapping: list[Mapping], *frames: DataFrame) -> list[str]:
    """The unique mapped columns that all frames have. None at all is an error: no row could be matched."""
    found = [m.column for m in mapping if m.unique and all(_has(f, m.column) for f in frames)]
    if not found:
        raise ValueError("no unique mapped column is present on both sides")
    return found


def _has(df: DataFrame, name: str) -> bool:
    return name.lower() in {c.lower() for c in df.columns}


def consolidate(
    merged: DataFrame | None,
    new: DataFrame,
    mapping: list[Mapping],
    on_conflict: str = "string",
    trust_unique: bool = False,
    measure: bool = False,
    refresh: bool = False,
    refuse_repeats: bool = False,
) -> DataFrame:
    """Bring a member table, already under consolidated names, into a consolidated table.

    A full outer join on the unique mapped columns. Where both sides have a
    mapped column the new value wins and the old one fills in for NULL; other
    columns of both sides are kept. Without a consolidated table yet, the member
    table is the result. NULL keys match nothing.

    A member brought in before is an error, or with ``refresh=True`` has its own
    columns replaced: a row it no longer feeds keeps NULL there. With
    ``refuse_repeats=True``, as for stored tables, a key that repeats on both
    sides is an error, since every pair of its rows would match.

    Spark runs a full outer join as one sort-merge join, which cannot broadcast
    a small side nor split a key holding a large share of the rows. So the join
    is composed of its matched rows and the unmatched rows of either side: each
    of the three can be broadcast or split, and unmatched rows are found by the
    distinct keys of the other side. ``trust_unique=True`` uses the plain full
    outer join, which moves each side once, where no key repeats much.
    ``measure=True``, for stored tables, finds out: a small member is broadcast,
    so that the consolidated table is not shuffled at all; else the plain join is
    used unless some key, or NULL, has very many rows on either side.
    """
    if merged is None:
        return new
    keys = unique_columns(mapping, merged, new)
    left, right = _agree(merged, new, [m.column for m in mapping], on_conflict)
    left_keys, right_keys = resolve(left, keys), resolve(right, keys)
    r_names = {c: f"_new_{i}" for i, c in enumerate(right.columns)}
    renamed = right.select(*[col(c).alias(n) for c, n in r_names.items()])
    condition = F.lit(True)
    for a, b in zip(left_keys, right_keys):
        condition = condition & (left[f"`{a}`"] == renamed[r_names[b]])

    right_of = {c.lower(): n for c, n in r_names.items()}
    mapped = {m.column.lower() for m in mapping}
    output = []
    for c in left.columns:
        n = right_of.get(c.lower())
        if n is None:
            output.append(col(c))
        elif c.lower() in mapped:
            output.append(F.coalesce(F.col(n), col(c)).alias(c))
        elif refresh:
            output.append(F.col(n).alias(c))
        else:
            raise ValueError(f"unmapped column {c} is on both sides; the member table is already merged")
    on_left = {c.lower() for c in left.columns}
    output += [F.col(n).alias(c) for c, n in r_names.items() if c.lower() not in on_left]

    few = False
    if refuse_repeats:
        _refuse_repeats(left, left_keys, renamed, [r_names[k] for k in right_keys])
    if measure and not trust_unique:
        renamed, few = broadcast_if_small(renamed)
        trust_unique = not few and all(
            heaviest_key(df, keys) <= HEAVY_KEY_ROWS
            for df, keys in ((renamed, [r_names[k] for k in right_keys]), (left, left_keys))
        )
    if trust_unique:
        return left.join(renamed, condition, "full").select(*output)
    seen_left, seen_right = left.select(*[col(k) for k in left_keys]), renamed
    if few:
        # Leaves only keys of the small side, ahead of any shuffle.
        seen_left = seen_left.join(renamed, condition, "left_semi")
    else:
        seen_right = renamed.select(*[r_names[k] for k in right_keys]).distinct()
    matched = left.join(renamed, condition, "inner").select(*output)
    only_left = left.join(seen_right, condition, "left_anti")
    only_right = renamed.join(seen_left.distinct(), condition, "left_anti")
    only_left = only_left.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in renamed.schema.fields])
    only_right = only_right.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields])
    return matched.unionByName(only_left.select(*output)).unionByName(only_right.select(*output))


def _refuse_repeats(left: DataFrame, left_keys: list[str], right: DataFrame, right_keys: list[str]) -> None:
    """Raise if a key without NULL repeats on both sides. Counts are summed map-side, so a hot key costs a row a task."""
    def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
        named = df.select(*[col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(keys)]).dropna()
        return named.groupBy(*named.columns).count().where("count > 1").drop("count")

    few = repeated(right, right_keys)
    both = repeated(left, left_keys).join(few, few.columns).limit(1).collect()
    if both:
        raise ValueError(f"unique columns {left_keys} repeat on both sides, as in {tuple(both[0])}")


def _agree(left: DataFrame, right: DataFrame, shared: list[str], on_conflict: str) -> tuple[DataFrame, DataFrame]:
    """Both frames with one type per mapped column they share."""
    common = [c for c in shared if _has(left, c) and _has(right, c)]
    common = list(dict.fromkeys(c.lower() for c in common))
    a, b = align_schemas(
        left.select(*[col(c) for c in resolve(left, common)]),
        right.select(*[col(c) for c in resolve(right, common)]),
        on_conflict,
    )
    kinds = {f.name.lower(): f.dataType for f in a.schema.fields}

    def cast(df):
        return df.select(*[
            col(f.name).cast(kinds[f.name.lower()]).alias(f.name)
            if f.name.lower() in kinds and kinds[f.name.lower()] != f.dataType
            else col(f.name)
            for f in df.schema.fields
        ])

    return cast(left), cast(right)


def propagate_changes(
    merged: DataFrame,
    changes: DataFrame,
    mapping: list[Mapping],
    table: str,
    alias: str,
    mode: str = "replace",
    compact: str | None = None,
    seq: str = "seq",
    op: str = "operation",
    on_conflict: str = "string",
    measure: bool = False,
) -> DataFrame:
    """A consolidated table after changes to one member table.

    ``changes`` are that table's decoded events, compacted already or compacted
    here by the unique columns when ``compact`` names a mode.

    ``replace``: every consolidated row of a changed key gives way to the
    changed row, so columns of other members become NULL in it; a delete removes
    the row. Several changed rows of one key are all kept.

    ``patch``: only the columns this member feeds are overwritten. A delete
    clears the columns fed by this member alone, and the row goes once no column
    beside its key holds a value. Needs one change per key, so it compacts by
    the unique columns.

    ``members``, for a table that records its members (``operators.members``): the
    member feeds the rows it writes and no others of a changed key, mapped values
    fall back to those of other members, and a row that nobody feeds goes.

    ``measure=True``, for changes that are stored, measures the changed keys and
    broadcasts them when small.
    """
    delta = changes.drop(MODIFIED)
    names = mapped_names(delta.columns, mapping, table, alias, keep=(op.lower(), seq.lower()))
    delta = delta.select(*[col(c).alias(n) for c, n in names.items()])
    keys = unique_columns(mapping, merged, delta)
    if mode == "patch":
        compact = compact or "latest"
        if compact != "latest":
            raise ValueError("patch needs one change per key")
    if compact is not None:
        delta = compact_changes(delta, keys, seq, op, compact)
    if mode == "replace":
        return _replace(merged, delta, keys, seq, op, on_conflict, measure)
    if mode == "patch":
        own = _own_columns(delta.columns, mapping, table, alias, {op, seq, *keys})
        return _patch(merged, delta, keys, own, op, seq, on_conflict, measure)
    if mode == "members":
        from cdclake.operators.members import propagate_member

        return propagate_member(merged, delta, keys, mapping, table, alias, seq, op, on_conflict, measure)
    raise ValueError(f"unknown mode {mode!r}")


def _replace(merged, delta, keys, seq, op, on_conflict, measure):
    old, new = align_schemas(merged.drop(op), delta.where(col(op) != DELETE).drop(op, seq), on_conflict)
    changed = delta.select(*[col(k) for k in resolve(delta, keys)]).distinct()
    if measure:
        changed, _ = broadcast_if_small(changed)
    kept = old.join(changed, keys_match(old, changed, keys), "left_anti")
    return kept.unionByName(new)


def keys_match(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition: the same values of ``keys``, NULL equal to NULL."""
    condition = F.lit(True)
    for k in keys:
        a, b = resolve(left, [k])[0], resolve(right, [k])[0]
        x, y = left[f"`{a}`"], right[f"`{b}`"]
        if left.schema[a].dataType != right.schema[b].dataType:
            x, y = x.cast("string"), y.cast("string")
        condition = condition & x.eqNullSafe(y)
    return condition


def _own_columns(columns, mapping, table, alias, skip) -> set[str]:
    """Columns no other member feeds, in lower case."""
    prefix = f"{alias}.{table}.".lower()
    shared = {m.column.lower() for m in mapping if any(not s.lower().startswith(prefix) for s in m.sources)}
    skip = {s.lower() for s in skip}
    return {c.lower() for c in columns if c.lower() not in shared and c.lower() not in skip}


def _patch(merged, delta, keys, own, op, seq, on_conflict, measure):
    old, new = align_schemas(merged.drop(op), delta.drop(op, seq), on_conflict)
    carried = {c.lower() for c in delta.columns}
    keys = resolve(old, keys)
    aligned, operation = new.columns, "_change_op"
    # The aligned rows again, with their operation, under names of their own.
    kinds = {f.name: f.dataType for f in new.schema.fields}
    spelled = {c.lower(): c for c in delta.columns}
    delta = delta.select(
        col(op).alias(operation),
        *[
            (col(spelled[c.lower()]).cast(kinds[c]) if c.lower() in spelled else F.lit(None).cast(kinds[c])).alias(f"_c{i}")
            for i, c in enumerate(aligned)
        ],
    )
    slot = {c: f"_c{i}" for i, c in enumerate(aligned)}
    few = False
    if measure:
        delta, few = broadcast_if_small(delta)
    match = F.lit(True)
    for k in keys:
        match = match & old[f"`{k}`"].eqNullSafe(delta[slot[k]])

    deleted = F.coalesce(F.col(operation) == DELETE, F.lit(False))
    columns = []
    for c in aligned:
        if c in keys or c.lower() not in carried:
            columns.append(col(c))
            continue
        value = F.when(F.col(operation).isNull(), col(c)).when(~deleted, F.col(slot[c]))
        columns.append((value if c.lower() in own else value.otherwise(col(c))).alias(c))
    patched = old.join(delta, match, "left").select(*columns, deleted.alias("_deleted"))
    alive = F.lit(False)
    for c in aligned:
        if c not in keys:
            alive = alive | col(c).isNotNull()
    patched = patched.where(~F.col("_deleted") | alive).drop("_deleted")

    written = delta.where(F.col(operation) != DELETE)
    present = old.select(*[col(k) for k in keys])
    if few:
        # Leaves only changed keys, ahead of any shuffle.
        present = present.join(delta, match, "left_semi")
    added = written.join(present.distinct(), match, "left_anti")
    return patched.unionByName(added.select(*[F.col(slot[c]).alias(c) for c in aligned]))


def targets_of(definitions: DataFrame, table: str, alias: str) -> DataFrame:
    """Merge definitions that have this table of this database among their members."""
    member = F.exists("list_tables", lambda t: (t["table"] == table) & (t["database_alias"] == alias))
    return definitions.where(member)


def new_members(old_definitions: DataFrame, new_definitions: DataFrame) -> DataFrame:
    """Member tables a merge definition gained; all of them for a definition not seen before."""

    def members(definitions):
        return definitions.select("merge_table_name", F.inline("list_tables"))

    known = members(old_definitions).select("merge_table_name", "table_id")
    return members(new_definitions).join(known, ["merge_table_name", "table_id"], "left_anti")
