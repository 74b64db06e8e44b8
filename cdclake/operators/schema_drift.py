"""Schema history: describing tables, keeping versions, reporting differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cdclake.functions.types import parse_source_type
from cdclake.model import COLUMN_PROPERTY

_NO_DEFAULT = "NULL"


def catalog_rows(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Columns of table copies in the shape of a database's column catalog."""
    rows = [
        (name, f.name, position, f.dataType.simpleString(), None)
        for name, df in tables.items()
        for position, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, ordinal_position int, data_type string, column_default string"
    )


def describe_tables(columns: DataFrame) -> DataFrame:
    """One row per table with its ``["column:type", …]`` text, in column order.

    Each list is one table's columns, which a database limits to a few
    thousand.
    """
    entry = F.concat_ws(":", F.lower("column_name"), F.col("data_type"))
    listed = F.array_sort(F.collect_list(F.struct("ordinal_position", entry.alias("entry"))))
    return columns.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("column_count"),
        F.to_json(F.transform(listed, lambda c: c["entry"])).alias("schema"),
    )


def column_properties(columns: DataFrame, *keep: str) -> DataFrame:
    """Catalog columns with their types taken apart, one row per column."""
    return columns.select(
        *keep,
        F.col("column_name").alias("field"),
        parse_source_type("data_type").alias("_t"),
        F.coalesce("column_default", F.lit(_NO_DEFAULT)).alias("defaultValue"),
    ).select(*keep, "field", "_t.type", "_t.typeSize", "_t.typeScale", "_t.isSigned", "defaultValue", "_t.possibleValues")


def pack_schemas(properties: DataFrame) -> DataFrame:
    """Column rows packed to one schema text per ``(db_type, table_name)``, ordered by field."""
    names = [f.name for f in COLUMN_PROPERTY.fields]
    column = F.struct(F.lower("field").alias("_order"), *names)
    listed = F.transform(F.array_sort(F.collect_list(column)), lambda c: F.struct(*[c[n].alias(n) for n in names]))
    return properties.groupBy("db_type", "table_name").agg(F.to_json(listed).alias("table_schema"))


def unpack_schemas(versions: DataFrame) -> DataFrame:
    """Schema texts as one row per column."""
    listed = F.from_json("table_schema", T.ArrayType(COLUMN_PROPERTY))
    return versions.select("db_type", "table_name", F.inline(listed)).select(
        "db_type", "table_name", "field", "type",
        F.coalesce("typeSize", F.lit(-1)).alias("typeSize"),
        "typeScale", "isSigned",
        F.coalesce("defaultValue", F.lit(_NO_DEFAULT)).alias("defaultValue"),
        F.array_sort(F.coalesce("possibleValues", F.array().cast("array<string>"))).alias("possibleValues"),
    )


def latest_schemas(versions: DataFrame) -> DataFrame:
    """The newest stored version of every table."""
    return versions.groupBy("db_type", "table_name").agg(
        F.max("id").alias("id"), F.max_by("table_schema", "id").alias("table_schema")
    )


def changed_schemas(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Current schema texts that differ from the stored ones, new tables included."""
    known = stored.select("db_type", "table_name", "table_schema")
    return current.join(known, ["db_type", "table_name", "table_schema"], "left_anti")


def record_schemas(rows: DataFrame, path: str, version: int) -> None:
    """Append schema texts as a new version."""
    rows.select(F.lit(version).cast("bigint").alias("id"), "db_type", "table_name", "table_schema").write.mode(
        "append"
    ).parquet(path)


def diff_tables(old: DataFrame, new: DataFrame, name: str = "table_name") -> DataFrame:
    """Table names of two lists, matched without case: ``common``, ``added`` or ``removed``."""
    sides = old.select(F.col(name).alias("name"), F.lit(0).alias("side")).unionByName(
        new.select(F.col(name).alias("name"), F.lit(1).alias("side"))
    )
    found = sides.groupBy(F.lower("name").alias("_key")).agg(
        F.coalesce(F.max(F.when(F.col("side") == 1, F.col("name"))), F.max("name")).alias("table_name"),
        F.min("side").alias("_first"),
        F.max("side").alias("_last"),
    )
    status = F.when(F.col("_first") != F.col("_last"), "common").when(F.col("_first") == 1, "added").otherwise("removed")
    return found.select("table_name", status.alias("status"))


def diff_schemas(old: DataFrame, new: DataFrame) -> DataFrame:
    """Differences between two sets of column rows, one event each.

    Fields match without case. Both sides meet in one aggregate keyed by field
    instead of a full outer join, so there is one shuffle, preceded by a partial
    aggregate. Signedness is stored but not compared.
    """
    parts = ["field", "type", "typeSize", "typeScale", "defaultValue", "possibleValues"]

    def side(df: DataFrame, at: int) -> DataFrame:
        values = F.struct(*parts)
        empty = F.lit(None).cast(df.select(values.alias("v")).schema["v"].dataType)
        return df.select(
            "db_type", "table_name", F.lower("field").alias("_key"),
            (values if at == 0 else empty).alias("_old"), (values if at == 1 else empty).alias("_new"),
        )

    pairs = (
        side(old, 0)
        .unionByName(side(new, 1))
        .groupBy("db_type", "table_name", "_key")
        .agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    )
    was, now = F.col("_old"), F.col("_new")
    # Most columns stay as they are.
    pairs = pairs.where(~was.eqNullSafe(now))
    both = was.isNotNull() & now.isNotNull()

    def event(when: Column, kind: str, before: Column, after: Column) -> Column:
        return F.when(
            when,
            F.struct(
                F.coalesce(now["field"], was["field"]).alias("fieldChanged"),
                F.lit(kind).alias("changeType"),
                before.cast("string").alias("oldValue"),
                after.cast("string").alias("newValue"),
            ),
        )

    def differs(part: str) -> Column:
        return both & ~was[part].eqNullSafe(now[part])

    def size_of(side: Column) -> Column:
        return F.concat_ws(",", side["typeSize"].cast("string"), side["typeScale"].cast("string"))

    candidates = F.array(
        event(was.isNull() | now.isNull(), "FIELD_CHANGED", was["field"], now["field"]),
        event(differs("type"), "TYPE_CHANGED", was["type"], now["type"]),
        event(differs("typeSize") | differs("typeScale"), "TYPE_SIZE_CHANGED", size_of(was), size_of(now)),
        event(differs("defaultValue"), "DEFAULT_VALUE_CHANGED", was["defaultValue"], now["defaultValue"]),
        event(differs("possibleValues"), "POSSIBLE_VALUE_CHANGE", was["possibleValues"], now["possibleValues"]),
    )
    return pairs.select(
        F.col("db_type").alias("dbType"),
        F.col("table_name").alias("dbTable"),
        F.inline(F.filter(candidates, lambda e: e.isNotNull())),
    )


def schema_alerts(
    events: DataFrame,
    host: str,
    created: str | None = None,
    owners: tuple[tuple[str, str], ...] = (),
    level: str = "WARNING",
    cycle: str = "REALTIME",
    process_name: str | None = None,
) -> DataFrame:
    """An alert per schema event. ``owners`` are pairs of name and phone."""
    kind = (
        F.when((F.col("changeType") == "FIELD_CHANGED") & F.col("oldValue").isNull(), "ADDED")
        .when((F.col("changeType") == "FIELD_CHANGED") & F.col("newValue").isNull(), "DELETED")
        .otherwise("CHANGED")
    )
    stamp = F.lit(created) if created else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    owner = F.array(*[F.struct(F.lit(n).alias("owner"), F.lit(p).alias("phone")) for n, p in owners])
    return events.select(
        F.format_string("TABLE %s@%s - FIELD: %s IS %s", "dbType", F.lit(host), "fieldChanged", kind).alias("msg"),
        owner.cast("array<struct<owner:string,phone:string>>").alias("owner"),
        stamp.alias("created"),
        stamp.alias("updated"),
        F.struct("dbType", "dbTable", "fieldChanged", "changeType", "oldValue", "newValue").alias("metrics"),
        F.format_string("%s.%s.%s@%s", "dbType", "dbTable", "fieldChanged", F.lit(host)).alias("entity_name"),
        F.lit("COLUMN").alias("entity_type"),
        F.lit(level).alias("alert_level"),
        F.lit(cycle).alias("alert_cycle"),
        F.lit(process_name).cast("string").alias("process_name"),
    )
