"""Schema evolution between two frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from cdclake.operators.columns import col

# Numeric types from narrow to wide, for on_conflict="widen".
_NUMERIC = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]
_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def align_schemas(left: DataFrame, right: DataFrame, on_conflict: str = "string") -> tuple[DataFrame, DataFrame]:
    """Give both frames the same columns: the left ones in order, then those only on the right.

    Names match without case and keep the left spelling. A column one side
    lacks is NULL there. Where types differ, ``on_conflict`` says what happens:
    ``string`` casts both to string, ``widen`` takes the wider of two numeric
    types and string otherwise, ``error`` raises. Two decimals always widen and
    the two timestamp types take the left one, since both hold the same values.
    """
    on_left = {f.name.lower(): f for f in left.schema.fields}
    on_right = {f.name.lower(): f for f in right.schema.fields}
    if len(on_left) < len(left.columns) or len(on_right) < len(right.columns):
        raise ValueError("columns that differ only in case cannot be aligned")
    out_left, out_right = [], []
    for key in list(on_left) + [k for k in on_right if k not in on_left]:
        a, b = on_left.get(key), on_right.get(key)
        name = (a or b).name
        if a is None or b is None:
            kind = (a or b).dataType
        elif a.dataType == b.dataType:
            kind = a.dataType
        else:
            kind = _common_type(name, a.dataType, b.dataType, on_conflict)
        out_left.append(_as(a, kind, name))
        out_right.append(_as(b, kind, name))
    return left.select(*out_left), right.select(*out_right)


def _as(field, kind, name):
    if field is None:
        return F.lit(None).cast(kind).alias(name)
    if field.dataType == kind:
        return col(field.name).alias(name)
    return col(field.name).cast(kind).alias(name)


def _common_type(name: str, a: T.DataType, b: T.DataType, on_conflict: str) -> T.DataType:
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return _wider_decimal(a, b)
    if {type(a), type(b)} == {T.TimestampType, T.TimestampNTZType}:
        return a
    if on_conflict == "error":
        raise ValueError(f"column {name} is {a.simpleString()} on one side and {b.simpleString()} on the other")
    if on_conflict == "widen":
        return _wider_numeric(a, b) or T.StringType()
    if on_conflict == "string":
        return T.StringType()
    raise ValueError(f"unknown on_conflict {on_conflict!r}")


def _wider_decimal(a: T.DecimalType, b: T.DecimalType) -> T.DataType:
    scale = max(a.scale, b.scale)
    precision = max(a.precision - a.scale, b.precision - b.scale) + scale
    return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()


def _wider_numeric(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if type(a) in _NUMERIC and type(b) in _NUMERIC:
        wide = max(type(a), type(b), key=_NUMERIC.index)
        narrow = min(type(a), type(b), key=_NUMERIC.index)
        # A float holds too few digits for int and bigint.
        if wide is T.FloatType and narrow in (T.IntegerType, T.LongType):
            wide = T.DoubleType
        # Nor does a double hold every bigint.
        if wide is T.DoubleType and narrow is T.LongType:
            return None
        return wide()
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.DecimalType) and type(y) in _WHOLE_DIGITS:
            return _wider_decimal(x, T.DecimalType(_WHOLE_DIGITS[type(y)], 0))
    return None
