"""Source column types: to Spark types, and to the parts schema tracking compares."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

# Source type name (lower case, without size) -> Spark type.
SOURCE_TYPES = {
    "bigint": "bigint",
    "bigserial": "bigint",
    "binary": "binary",
    "bit": "string",
    "blob": "binary",
    "bool": "boolean",
    "boolean": "boolean",
    "bytea": "binary",
    "char": "string",
    "character": "string",
    "clob": "string",
    "date": "date",
    "datetime": "timestamp",
    "dec": "decimal",
    "decimal": "decimal",
    "double": "double",
    "enum": "string",
    "float": "float",
    "int": "int",
    "integer": "int",
    "interval": "string",
    "json": "string",
    "jsonb": "string",
    "longblob": "binary",
    "longtext": "string",
    "mediumblob": "binary",
    "mediumint": "int",
    "mediumtext": "string",
    "nchar": "string",
    "nclob": "string",
    "number": "decimal",
    "numeric": "decimal",
    "raw": "binary",
    "real": "float",
    "serial": "int",
    "set": "string",
    "smallint": "smallint",
    "smallserial": "smallint",
    "string": "string",
    "text": "string",
    "time": "string",
    "timestamp": "timestamp",
    "timestamptz": "timestamp",
    "tinyblob": "binary",
    "tinyint": "tinyint",
    "tinytext": "string",
    "user-defined": "string",
    "uuid": "string",
    "varbinary": "binary",
    "varchar": "string",
    "varchar2": "string",
    "xml": "string",
    "year": "int",
}

# Names only one dialect uses, or uses differently.
DIALECT_TYPES = {
    "mysql": {
        "real": "double",
    },
    "oracle": {
        "bfile": "string",
        "binary_double": "double",
        "binary_float": "float",
        "date": "timestamp",
        "float": "double",
        "long": "string",
        "real": "double",
        "rowid": "string",
    },
    "postgresql": {
        "array": "string",
        "bpchar": "string",
        "float": "double",
        "float4": "float",
        "float8": "double",
        "inet": "string",
        "int2": "smallint",
        "int4": "int",
        "int8": "bigint",
        "money": "string",
        "oid": "bigint",
    },
}

# The type that holds the full range of an unsigned integer.
UNSIGNED = {
    "tinyint": "smallint",
    "smallint": "int",
    "int": "bigint",
    "bigint": "decimal(20,0)",
}

# A decimal type without a size: PostgreSQL keeps any number of digits on either
# side, so only text holds all of its values.
BARE_DECIMAL = {"mysql": "decimal(10,0)", "oracle": "decimal(38,0)", "postgresql": "string"}
BARE_NUMBER = "decimal(38,10)"

_SOURCE_TYPE = re.compile(r"^\s*([A-Za-z0-9_\-]+)\s*(?:\(([^)]*)\))?\s*(.*)$")


def type_names(dialect: str) -> dict[str, str]:
    return SOURCE_TYPES | DIALECT_TYPES.get(dialect.lower(), {})


def map_source_type(text: str, dialect: str = "mysql", number_as: str = "decimal") -> tuple[T.DataType, bool]:
    """Spark type of a source column type, and whether the type name was known.

    Unknown names become strings. A bare Oracle ``NUMBER`` has no declared
    scale: ``decimal(38,10)``, or a string with ``number_as="string"``. A bare
    PostgreSQL ``numeric`` is a string, and so are arrays of any type. Oracle's
    ``LONG RAW`` holds bytes, though ``LONG`` is text.
    """
    found = _SOURCE_TYPE.match(text or "")
    if not found:
        return T.StringType(), False
    base, args, rest = found.group(1).lower(), found.group(2), found.group(3).lower()
    if any(part in base for part in ("varchar", "clob", "text")):
        return T.StringType(), True
    if "[]" in rest:
        return T.StringType(), True
    if base == "long" and rest.split()[:1] == ["raw"]:
        return T.BinaryType(), True
    target = type_names(dialect).get(base)
    if target is None:
        return T.StringType(), False
    if target == "decimal":
        sizes = [38 if n == "*" else int(n) for n in re.findall(r"-?\d+|\*", args or "")]
        if not sizes:
            bare = BARE_NUMBER if base == "number" else BARE_DECIMAL.get(dialect.lower(), "decimal(10,0)")
            bare = "string" if base == "number" and number_as == "string" else bare
            return T.DataType.fromDDL(bare), True
        return _decimal(sizes), True
    if "unsigned" in rest:
        target = UNSIGNED.get(target, target)
    return T.DataType.fromDDL(target), True


def _decimal(sizes: list[int]) -> T.DataType:
    precision, scale = (sizes + [0])[:2]
    if scale < 0:
        precision, scale = precision - scale, 0
    precision = max(precision, scale)
    # Wider than any Spark decimal: text keeps every digit.
    return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()


def parse_source_type(text: Column | str) -> Column:
    """Struct of the type parts that schema tracking stores and compares.

    ``typeSize`` is the number that begins the brackets, -1 without one, and
    ``typeScale`` the number after the comma, if any. ``type`` is what stands
    outside the brackets, without the sign. ``possibleValues`` are the sorted
    members of an enum or set; a member's doubled quotes stand for one.
    """
    text = F.col(text) if isinstance(text, str) else text
    part = lambda pattern, group=1: F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))
    listed = text.rlike(r"(?i)^\s*(enum|set)\s*\(")
    outside = F.concat_ws(" ", part(r"^\s*([^(]*[^(\s])"), part(r"\)\s*([^()]*[^()\s])\s*$"))
    members = F.regexp_extract_all(text, F.lit(r"'((?:[^']|'')*)'"), F.lit(1))
    return F.struct(
        F.when(listed, F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))
        .otherwise(F.regexp_replace(outside, r"(?i)\s+(un)?signed\b", "")).alias("type"),
        F.when(~listed, F.coalesce(part(r"\(\s*(\d+)").try_cast("int"), F.lit(-1))).otherwise(F.lit(-1)).alias("typeSize"),
        F.when(~listed, part(r"\([^)]*,\s*(-?\d+)\s*\)").try_cast("int")).alias("typeScale"),
        F.when(text.rlike(r"(?i)\bunsigned\b") & ~listed, F.lit(False))
        .when(text.rlike(r"(?i)\bsigned\b") & ~listed, F.lit(True))
        .alias("isSigned"),
        F.when(listed, F.array_sort(F.transform(members, lambda m: F.replace(m, F.lit("''"), F.lit("'")))))
        .otherwise(F.array().cast("array<string>")).alias("possibleValues"),
    )


def spark_type_name(text: Column | str, dialect: str = "mysql", number_as: str = "decimal") -> Column:
    """``map_source_type`` as a column expression, giving the Spark type name; NULL if unknown."""
    text = F.col(text) if isinstance(text, str) else text
    base = F.lower(F.regexp_extract(text, r"^\s*([A-Za-z0-9_\-]+)", 1))
    names = F.create_map(*[F.lit(x) for pair in type_names(dialect).items() for x in pair])
    target = names[base]
    first = F.regexp_extract(text, r"\(\s*(\d+|\*)", 1)
    precision = F.when(first == "*", F.lit(38)).otherwise(first.try_cast("int"))
    scale = F.coalesce(F.regexp_extract(text, r",\s*(-?\d+)", 1).try_cast("int"), F.lit(0))
    whole = F.when(scale < 0, precision - scale).otherwise(F.greatest(precision, scale))
    fraction = F.greatest(scale, F.lit(0))
    bare = "string" if number_as == "string" else BARE_NUMBER
    decimal = (
        F.when(precision.isNull(), F.when(base == "number", F.lit(bare)).otherwise(F.lit(BARE_DECIMAL.get(dialect.lower(), "decimal(10,0)"))))
        .when(whole <= 38, F.format_string("decimal(%d,%d)", whole, fraction))
        .otherwise(F.lit("string"))
    )
    unsigned = F.create_map(*[F.lit(x) for pair in UNSIGNED.items() for x in pair])
    return (
        F.when(base.rlike("varchar|clob|text") | F.contains(text, F.lit("[]")), F.lit("string"))
        .when(F.lower(text).rlike(r"^\s*long\s+raw\b"), F.lit("binary"))
        .when(target == "decimal", decimal)
        .when(F.lower(text).rlike(r"\bunsigned\b"), F.coalesce(unsigned[target], target))
        .otherwise(target)
    )
