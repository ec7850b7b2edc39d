"""Cell text: strings for any column, float text, TSV escapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def escape_tsv(text: Column) -> Column:
    """TAB, LF and CR as two-character escapes; backslashes stay as they are."""
    for raw, escaped in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def float_text(value: Column) -> Column:
    """Shortest float text: exponent form below 1e-4 and from 1e6 upwards."""
    shown = F.abs(value).cast("string")
    parts = "^([0-9]+)\\.([0-9]+)(?:E(-?[0-9]+))?$"
    whole = F.regexp_extract(shown, parts, 1)
    fraction = F.regexp_extract(shown, parts, 2)
    exponent = F.regexp_extract(shown, parts, 3)
    all_digits = F.ltrim(F.concat(whole, fraction), F.lit("0"))
    zeros = F.length(whole) + F.length(fraction) - F.length(all_digits)
    # Position of the decimal point relative to the first significant digit.
    point = (
        F.length(whole)
        - zeros
        + F.when(exponent == "", F.lit(0)).otherwise(exponent.try_cast("int"))
    )
    digits = F.rtrim(all_digits, F.lit("0"))
    count = F.length(digits)
    power = point - 1
    mantissa = F.concat(
        F.left(digits, F.lit(1)),
        F.when(count > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), count))).otherwise(""),
    )
    scientific = F.concat(
        mantissa,
        F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(power) < 10, F.lit("0")).otherwise(""),
        F.abs(power).cast("string"),
    )
    plain = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(count <= point, F.concat(digits, F.repeat(F.lit("0"), point - count)))
        .otherwise(
            F.concat(
                F.left(digits, point), F.lit("."), F.substring(digits, point + 1, count)
            )
        )
    )
    negative = F.startswith(value.cast("string"), F.lit("-"))
    unsigned = (
        F.when(value == 0, F.lit("0"))
        .when((power < -4) | (power >= 6), scientific)
        .otherwise(plain)
    )
    infinite = F.abs(value) == F.lit(float("inf"))
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(value), F.lit("NaN"))
        .when(infinite & (value > 0), F.lit("+Inf"))
        .when(infinite, F.lit("-Inf"))
        .otherwise(F.concat(F.when(negative, F.lit("-")).otherwise(""), unsigned))
    )


def timestamp_text(value: Column) -> Column:
    """RFC 3339 in UTC, trailing fraction zeros cut. Needs a UTC session."""
    return F.concat(F.replace(value.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def scalar_text(value: Column, data_type: T.DataType) -> Column:
    """Text of a scalar, null when the value is null."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return float_text(value)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return timestamp_text(value)
    if isinstance(data_type, T.BinaryType):
        return F.decode(value, "UTF-8")
    return value.cast("string")


def stringify_cell(value: Column, data_type: T.DataType) -> Column:
    """Text of a table cell; null becomes the empty string."""
    return F.coalesce(scalar_text(value, data_type), F.lit(""))


def render_line(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One TSV line (without its line feed) from the columns in order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = [
        escape_tsv(stringify_cell(F.col(f"`{c}`"), types[c]))
        if isinstance(types[c], (T.StringType, T.BinaryType))
        else stringify_cell(F.col(f"`{c}`"), types[c])
        for c in (columns or df.columns)
    ]
    return F.concat_ws("\t", *cells)
