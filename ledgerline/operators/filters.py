"""Row filters: units, empty messages, time intervals, value lists."""

from __future__ import annotations

import re
from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.regex import compile_pattern, glob_to_java

IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_RFC3339 = re.compile(
    r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})(?:\.(\d+))?(Z|[+-]\d{2}:\d{2})"
)


def unit_condition(mask: str, unit: str = "systemd_unit") -> Column | None:
    """Condition for a unit mask: empty, ``regex:``, shell mask or exact name."""
    mask = mask.strip()
    name = F.coalesce(F.col(unit), F.lit(""))
    if not mask:
        return None
    if mask.startswith("regex:"):
        return F.rlike(name, F.lit(compile_pattern(mask[len("regex:") :]).java))
    if any(c in mask for c in "*?["):
        java = glob_to_java(mask)
        return F.lit(False) if java is None else F.rlike(name, F.lit(java))
    # Bare equality reaches the file scan as a pushed filter.
    return F.col(unit) == mask


def unit_filter(df: DataFrame, mask: str = "", unit: str = "systemd_unit") -> DataFrame:
    condition = unit_condition(mask, unit)
    return df if condition is None else df.filter(condition)


def nonempty_message(df: DataFrame, message: str = "message") -> DataFrame:
    return df.filter(F.col(message) != "")


def _known_column(df: DataFrame, name: str) -> str:
    if not IDENTIFIER.fullmatch(name):
        raise ValueError(f"column {name!r} must match {IDENTIFIER.pattern}")
    if name not in df.columns:
        raise ValueError(f"column {name!r} not found")
    return name


def parse_instant(text: str) -> datetime:
    """An RFC 3339 instant, cut to microseconds."""
    match = _RFC3339.fullmatch(text.strip())
    if not match:
        raise ValueError(f"unsupported time {text!r} (expected RFC 3339)")
    base, fraction, zone = match.groups()
    micros = (fraction or "")[:6].ljust(6, "0")
    value = datetime.fromisoformat(f"{base}.{micros}{'+00:00' if zone == 'Z' else zone}")
    return value.astimezone(timezone.utc)


def time_range(
    df: DataFrame,
    start: str | datetime,
    end: str | datetime,
    column: str = "ts_orig",
    date_column: str | None = None,
) -> DataFrame:
    """Rows with ``start <= column < end``.

    ``date_column`` names a partition column holding the column's UTC date; the
    derived condition lets Spark skip whole partitions.
    """
    _known_column(df, column)
    low = parse_instant(start) if isinstance(start, str) else start
    high = parse_instant(end) if isinstance(end, str) else end
    if not low < high:
        raise ValueError("invalid interval: start must be before end")
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        # A zone-less literal keeps the column bare, so the filter is pushed down.
        bounds = [F.lit(v.astimezone(timezone.utc).replace(tzinfo=None)) for v in (low, high)]
    else:
        bounds = [F.lit(v) for v in (low, high)]
    out = df.filter((F.col(column) >= bounds[0]) & (F.col(column) < bounds[1]))
    if date_column:
        out = out.filter(
            F.col(date_column).between(
                F.lit(low.astimezone(timezone.utc).date()), F.lit(high.astimezone(timezone.utc).date())
            )
        )
    return out


def parse_lists(specs: list[str]) -> dict[str, list[str]]:
    """``field=v1,v2`` specifications; a repeated field collects its values."""
    lists: dict[str, list[str]] = {}
    for spec in specs:
        field, sign, values = spec.strip().partition("=")
        field = field.strip()
        if not sign:
            raise ValueError(f"filter {spec!r} must have the form field=v1,v2")
        if not IDENTIFIER.fullmatch(field):
            raise ValueError(f"filter field {field!r} must match {IDENTIFIER.pattern}")
        wanted = [v.strip() for v in values.split(",") if v.strip()]
        if not wanted:
            raise ValueError(f"filter {spec!r} has no values")
        known = lists.setdefault(field, [])
        known += [v for v in dict.fromkeys(wanted) if v not in known]
    return lists


def _listed(text: str, kind: T.DataType, field: str):
    """A list's value in the column's type; numbers out of its range match nothing (None)."""
    try:
        if isinstance(kind, T.BooleanType):
            return {"true": True, "false": False}[text.lower()]
        if isinstance(kind, T.IntegralType):
            number = int(text)
            bits = {"tinyint": 8, "smallint": 16, "int": 32}.get(kind.simpleString(), 64)
            return number if -(1 << bits - 1) <= number < 1 << bits - 1 else None
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return float(text)
        if isinstance(kind, T.DecimalType):
            number = Decimal(text)
            fits = number.is_finite() and number == number.quantize(Decimal(1).scaleb(-kind.scale))
            return number if fits and abs(number) < Decimal(10) ** (kind.precision - kind.scale) else None
        if isinstance(kind, T.DateType):
            return date.fromisoformat(text)
        if isinstance(kind, T.TimestampNTZType):
            return parse_instant(text).replace(tzinfo=None)
        if isinstance(kind, T.TimestampType):
            return parse_instant(text)
    except (ValueError, KeyError, ArithmeticError):
        raise ValueError(f"filter {field}: {text!r} is no {kind.simpleString()}") from None
    raise ValueError(f"filter {field}: columns of type {kind.simpleString()} can't be listed")


def in_lists(df: DataFrame, specs: list[str] | dict[str, list[str]]) -> DataFrame:
    """Rows whose value is in every field's list.

    Values are converted to the column's type here (times are RFC 3339), so the
    column stays bare and the filter reaches the file scan.
    """
    lists = parse_lists(specs) if isinstance(specs, list) else specs
    for field, values in lists.items():
        _known_column(df, field)
        kind = df.schema[field].dataType
        if not isinstance(kind, T.StringType):
            values = [v for v in (_listed(text, kind, field) for text in values) if v is not None]
        df = df.filter(F.col(field).isin([F.lit(v) for v in values]) if values else F.lit(False))
    return df
