"""Change events: encoding, decoding and the schema they carry."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from cdclake.functions.types import map_source_type, spark_type_name
from cdclake.model import APPLY_REQUEST, CHANGE, MERGE_REQUEST, MODIFIED, QUERY_REQUEST, TableRef
from cdclake.operators.columns import col

_REQUESTS = {"apply": APPLY_REQUEST, "merge": MERGE_REQUEST, "query": QUERY_REQUEST}
_BROKEN = "_broken"
UNFIT = "values that do not fit"


def table_key(url: str = "database_url", port: str = "database_port", name: str = "database_name",
              table: str = "table_name") -> Column:
    """Name of a table's change stream. The table part has one case, whatever the log says."""
    return F.concat_ws("-", F.lit("cdc"), col(url), col(port), col(name), F.lower(col(table)))


def decode_envelope(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Change events from messages, with the table each one belongs to."""
    event = F.from_json(col(value_col).cast("string"), CHANGE)
    return raw.select(event.alias("_event")).select("_event.*").withColumn("table_key", table_key())


def decode_requests(raw: DataFrame, kind: str, topic: str | None = None) -> DataFrame:
    """Distinct ``apply``, ``merge`` or ``query`` requests from messages, one topic of them if given.

    Apply requests also name the change stream to read.
    """
    if topic is not None:
        raw = raw.where(F.col("topic") == topic)
    requests = raw.select(F.from_json(F.col("value").cast("string"), _REQUESTS[kind]).alias("_r")).select("_r.*").distinct()
    if kind == "apply":
        requests = requests.withColumn("topic_cdc", table_key("server_host", "port", "database", "table"))
    return requests


def encode_changes(df: DataFrame, operation: int | Column, *, source: TableRef, seq: Column, created: Column) -> DataFrame:
    """Rows as change events.

    Values travel as text, as most source databases send them, so that no digit
    of a number or timestamp is lost on the way.
    """
    schema = json.dumps([f"{f.name.lower()}:{_source_name(f.dataType)}" for f in df.schema.fields], separators=(",", ":"))
    image = F.to_json(
        F.struct(*[_as_text(f).alias(f.name.lower()) for f in df.schema.fields]), {"ignoreNullFields": "false"}
    )
    op = F.lit(operation) if isinstance(operation, int) else operation
    return df.select(
        seq.cast("bigint").alias("id"),
        F.lit(source.host).alias("database_url"),
        F.lit(str(source.port)).alias("database_port"),
        F.lit(source.database).alias("database_name"),
        F.lit(source.table).alias("table_name"),
        F.lit(schema).alias("schema"),
        image.alias("value"),
        op.cast("int").alias("operation"),
        created.cast("bigint").alias("created"),
    )


def _as_text(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(col(field.name))
    if isinstance(field.dataType, T.BinaryType):
        # Text of arbitrary bytes would not survive; this is how bytea is written.
        return F.concat(F.lit("\\x"), F.lower(F.hex(col(field.name))))
    return col(field.name).cast("string")


def _typed(text: Column, kind: T.DataType) -> Column:
    """A value of an image as its column's type; NULL if it does not fit. Bytes may be written as ``\\x`` and hex digits."""
    if isinstance(kind, T.BinaryType):
        digits = F.regexp_extract(text, r"^\\x((?:[0-9A-Fa-f]{2})*)$", 1)
        return F.when(text.rlike(r"^\\x(?:[0-9A-Fa-f]{2})*$"), F.unhex(digits)).otherwise(text.cast("binary"))
    return text.try_cast(kind)


def _source_name(kind: T.DataType) -> str:
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return "json"
    if isinstance(kind, T.TimestampNTZType):
        return "timestamp"
    return kind.simpleString()


def schema_entries(changes: DataFrame) -> DataFrame:
    """The distinct column entries of a log's ``schema`` texts, with the newest event naming each.

    Aggregates the texts first, so that each distinct one is parsed once.
    """
    texts = changes.groupBy("schema").agg(F.max("id").alias("last_id"))
    entries = texts.select("last_id", F.posexplode(F.from_json("schema", "array<string>")).alias("position", "entry"))
    return (
        entries.where(F.contains("entry", F.lit(":")))
        .select(
            F.substring_index("entry", ":", 1).alias("name"),
            F.expr("substring(entry, locate(':', entry) + 1)").alias("source_type"),
            "position",
            "last_id",
        )
        .groupBy("name", "source_type")
        .agg(F.max("last_id").alias("last_id"), F.max_by("position", F.struct("last_id", "position")).alias("position"))
    )


def typed_entries(changes: DataFrame, dialect: str, number_as: str = "decimal") -> DataFrame:
    """The distinct column entries with the Spark type each maps to, and whether its source type is known."""
    kind = spark_type_name("source_type", dialect, number_as)
    return schema_entries(changes).select(
        "name", "source_type", "position", "last_id",
        F.coalesce(kind, F.lit("string")).alias("spark_type"), kind.isNotNull().alias("known"),
    )


class ImageColumn:
    """A column of the row images: its output name and type, and how images may spell it."""

    def __init__(self, name: str, kind: T.DataType, known: bool = True, spellings: tuple[str, ...] = ()):
        self.name, self.kind, self.known = name, kind, known
        self.spellings = list(dict.fromkeys([*spellings, name, name.lower(), name.upper()]))


def image_columns(changes: DataFrame, dialect: str, number_as: str = "decimal") -> list[ImageColumn]:
    """The columns a batch of events carries.

    Runs one small job: what reaches the driver is one row per distinct column
    and type, never one per event. A column that changed its type within the
    batch has the type of its newest event.
    """
    by_name: dict[str, list] = {}
    for entry in schema_entries(changes).collect():
        by_name.setdefault(entry["name"].lower(), []).append(entry)
    newest = {name: max(rows, key=lambda r: (r["last_id"], r["source_type"])) for name, rows in by_name.items()}
    columns = []
    for name in sorted(newest, key=lambda n: (newest[n]["position"], n)):
        kind, known = map_source_type(newest[name]["source_type"], dialect, number_as)
        columns.append(ImageColumn(name, kind, known, tuple(sorted({r["name"] for r in by_name[name]}))))
    return columns


def changes_schema(changes: DataFrame, dialect: str, number_as: str = "decimal") -> list[tuple[str, T.DataType]]:
    """Name and Spark type of every column in a batch of events."""
    return [(c.name, c.kind) for c in image_columns(changes, dialect, number_as)]


def decode_changes(
    changes: DataFrame,
    dialect: str,
    modified: str | None = None,
    number_as: str = "decimal",
    columns: list[ImageColumn] | list[tuple[str, T.DataType]] | None = None,
    op: str = "operation",
    seq: str = "seq",
    observation: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Typed rows of one table's events, and the events that cannot be decoded.

    Rows carry the columns named in the batch's ``schema`` texts (or
    ``columns``), the operation, the log position and, when given, the load
    stamp. The second frame holds events without a position, a known operation
    or a readable image, with the ``reason``; together the two frames hold every
    event. A value that does not fit its type becomes NULL in the first frame, and
    its whole event is in the second one too, with the names of such columns as
    the reason, so that no value is lost unseen.

    Each frame parses the events when it is used. An ``observation`` counts the
    ``undecoded`` and the ``unfit`` events while the rows are computed, so that
    the second frame need only be used if there are any.
    """
    if columns is None:
        columns = image_columns(changes, dialect, number_as)
    columns = [c if isinstance(c, ImageColumn) else ImageColumn(*c) for c in columns]
    taken = {op.lower(), seq.lower(), MODIFIED} & {c.name.lower() for c in columns}
    if taken:
        raise ValueError(f"table columns {sorted(taken)} clash with event columns; pass other names as op= and seq=")

    # Parsed by position: spellings that differ only in case cannot be told
    # apart by name afterwards.
    spellings = [s for c in columns for s in c.spellings]
    parsed = F.from_json(
        F.col("value").cast("string"),
        T.StructType([T.StructField(s, T.StringType()) for s in [*spellings, _BROKEN]]),
        {"columnNameOfCorruptRecord": _BROKEN},
    )
    slots = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(spellings))])
    image = parsed.cast(T.StructType([*slots.fields, T.StructField(_BROKEN, T.StringType())]))
    events = changes.select(*[col(c) for c in changes.columns], image.alias("_image"))

    reason = (
        F.when(F.col("id").isNull(), "no position")
        .when(~F.coalesce(F.col("operation").isin(1, 2, 3), F.lit(False)), "unknown operation")
        .when(F.col("value").isNull(), "no row image")
        .when(F.col(f"_image.{_BROKEN}").isNotNull() | F.col("_image").isNull(), "broken row image")
    )
    fields, unfit, slot = [], [], 0
    for c in columns:
        texts = [F.col(f"_image._{slot + i}") for i in range(len(c.spellings))]
        slot += len(c.spellings)
        text = F.coalesce(*texts)
        value = _typed(text, c.kind)
        fields.append(value.alias(c.name))
        if not isinstance(c.kind, (T.StringType, T.BinaryType)):
            unfit.append((c.name, text.isNotNull() & value.isNull()))
    misfit = F.lit(False)
    for _, lost in unfit:
        misfit = misfit | lost
    counted = events if observation is None else events.observe(
        observation, F.count(reason).alias("undecoded"), F.count_if(reason.isNull() & misfit).alias("unfit")
    )
    # A generator, not a filter: a pushed-down filter would parse each image twice.
    row = F.struct(*fields, F.col("operation").alias(op), F.col("id").cast("bigint").alias(seq))
    rows = counted.select(F.inline(F.when(reason.isNull(), F.array(row))))
    if modified is not None:
        rows = rows.withColumn(MODIFIED, F.lit(modified))
    named = F.concat_ws(", ", *[F.when(lost, F.lit(name)) for name, lost in unfit]) if unfit else F.lit("")
    reason = F.coalesce(reason, F.when(misfit, F.concat(F.lit(f"{UNFIT}: "), named)))
    rejected = events.select(*[col(c) for c in changes.columns], reason.alias("reason")).where("reason is not null")
    return rows, rejected
