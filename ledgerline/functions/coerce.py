"""Coercion of transformed values to the declared column types."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import scalar_text
from ledgerline.functions.transforms import (
    Parsed,
    check_transform,
    flexible_instant,
    floating_number,
    signed_number,
    trimmed,
    truth,
    unsigned_number,
)
from ledgerline.schema import COLUMN_TYPES, INTEGER_RANGES, UINT64

# The type a transform yields.
VALUE_TYPES: dict[str, T.DataType] = {
    "": T.StringType(),
    "string": T.StringType(),
    "int": T.LongType(),
    "int64": T.LongType(),
    "uint64": UINT64,
    "float64": T.DoubleType(),
    "bool": T.BooleanType(),
    "rfc3339": T.TimestampType(),
    "timestamp64": T.TimestampType(),
    "timestamp64_us": T.TimestampType(),
}

TEXT_COLUMNS = {"utf8", "bytes", "json", "jsondocument", "yson"}
INTEGER_COLUMNS = set(INTEGER_RANGES)
FLOAT_COLUMNS = {"float", "double"}
TIME_COLUMNS = {"timestamp", "timestamp64"}


def transform_fits(name: str | None, column_type: str) -> bool:
    """Whether values of the transform can ever fit the column type."""
    kind = VALUE_TYPES[check_transform(name)]
    if isinstance(kind, T.StringType):
        return True
    allowed = set(TEXT_COLUMNS)
    if isinstance(kind, (T.LongType, T.DecimalType)):
        allowed |= INTEGER_COLUMNS | FLOAT_COLUMNS
    elif isinstance(kind, T.DoubleType):
        allowed |= FLOAT_COLUMNS
    elif isinstance(kind, T.BooleanType):
        allowed |= {"bool"}
    else:
        allowed |= TIME_COLUMNS
    return column_type in allowed


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _is_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def _rejected(column_type: str) -> Column:
    return F.lit(None).cast(COLUMN_TYPES[column_type])


def to_text(value: Column, kind: T.DataType) -> Column:
    return scalar_text(value, kind)


def to_binary(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return value
    return F.encode(value, "UTF-8") if isinstance(kind, T.StringType) else _rejected("bytes")


def to_boolean(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return value
    return truth(trimmed(value)) if isinstance(kind, T.StringType) else _rejected("bool")


def _whole(value: Column, kind: T.DataType) -> Column:
    """A number as decimal, null when it has a fraction (or is not finite)."""
    if _is_float(kind):
        return F.when(value == F.floor(value), value.try_cast("decimal(38,0)"))
    return value.cast("decimal(38,0)")


def to_signed(value: Column, kind: T.DataType, column_type: str = "int64") -> Column:
    low, high = INTEGER_RANGES[column_type]
    if isinstance(kind, T.StringType):
        number = signed_number(trimmed(value))
    elif _is_number(kind):
        number = _whole(value, kind)
    else:
        return _rejected(column_type)
    return F.when(number.between(low, high), number).try_cast(COLUMN_TYPES[column_type])


def to_unsigned(value: Column, kind: T.DataType, column_type: str = "uint64") -> Column:
    _, high = INTEGER_RANGES[column_type]
    if isinstance(kind, T.StringType):
        number = unsigned_number(trimmed(value))
    elif _is_number(kind):
        number = _whole(value, kind)
    else:
        return _rejected(column_type)
    return F.when((number >= 0) & (number <= F.lit(Decimal(high))), number).try_cast(COLUMN_TYPES[column_type])


def to_floating(value: Column, kind: T.DataType, column_type: str = "double") -> Column:
    if isinstance(kind, T.StringType):
        number = floating_number(trimmed(value))
    elif _is_number(kind):
        number = value
    else:
        return _rejected(column_type)
    return number.cast(COLUMN_TYPES[column_type])


def to_timestamp(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return value
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return flexible_instant(value.cast("string"))
    if _is_number(kind) and not _is_float(kind):
        return F.timestamp_micros(value.try_cast("bigint"))
    return _rejected("timestamp64")


def coerce(value: Column, kind: T.DataType, column_type: str) -> Parsed:
    """The value in the column's type, with an error flag for what cannot fit."""
    if column_type in ("utf8", "json", "jsondocument"):
        out = to_text(value, kind)
    elif column_type in ("bytes", "yson"):
        out = to_binary(value, kind)
    elif column_type == "bool":
        out = to_boolean(value, kind)
    elif column_type.startswith("int"):
        out = to_signed(value, kind, column_type)
    elif column_type.startswith("uint"):
        out = to_unsigned(value, kind, column_type)
    elif column_type in FLOAT_COLUMNS:
        out = to_floating(value, kind, column_type)
    elif column_type in TIME_COLUMNS:
        out = to_timestamp(value, kind)
    else:
        raise ValueError(f"unsupported column type {column_type!r}")
    return Parsed(out, value.isNotNull() & out.isNull())
