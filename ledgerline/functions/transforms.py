"""Value transforms: text in, a typed value and an error flag out.

Each guard pattern states exactly which text is accepted; Spark's own casts
accept more (spaces, suffixes, partial dates), so a cast never decides alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schema import INTEGER_RANGES, UINT64

# The accepted spellings of booleans.
TRUE_TEXT = ["1", "t", "T", "TRUE", "true", "True"]
FALSE_TEXT = ["0", "f", "F", "FALSE", "false", "False"]

# White space that trimming removes.
BLANKS = "\t\n\x0b\f\r \u0085\u00a0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
)

SIGNED = r"^[+-]?[0-9]+\z"
UNSIGNED = r"^[0-9]+\z"
_DIGITS = r"[0-9](?:_?[0-9])*"
_HEX = r"[0-9a-fA-F](?:_?[0-9a-fA-F])*"
DECIMAL_FLOAT = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\z"
HEX_FLOAT = rf"^[+-]?0[xX]_?(?:{_HEX}\.?(?:{_HEX})?|\.{_HEX})[pP][+-]?{_DIGITS}\z"
INFINITE = r"(?i)^[+-]?inf(?:inity)?\z"
NOT_A_NUMBER = r"(?i)^nan\z"

_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
_TIME = r"[0-9]{1,2}:[0-9]{2}:[0-9]{2}(?:[.,][0-9]+)?"
_ZONE = r"(?:Z|[+-][0-9]{2}:[0-9]{2})"
RFC3339 = rf"^{_DATE}T{_TIME}{_ZONE}\z"
ZONED = rf"^{_DATE}[T ]{_TIME}{_ZONE}\z"
ZONELESS = rf"^{_DATE}(?:[T ]{_TIME})?\z"

SIGNED_KINDS = ("int", "int64")
TEMPORAL_KINDS = ("rfc3339", "timestamp64", "timestamp64_us")


@dataclass(frozen=True)
class Parsed:
    """A typed value, null when absent or wrong, and whether it was wrong."""

    value: Column
    error: Column


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def _checked(text: Column, value: Column) -> Parsed:
    return Parsed(value, text.isNotNull() & value.isNull())


def signed_number(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit(SIGNED)), text.try_cast("bigint"))


def unsigned_number(text: Column) -> Column:
    digits = F.regexp_replace(text, "^0+(?=.)", "")
    number = F.when(
        F.rlike(text, F.lit(UNSIGNED)) & (F.length(digits) <= 20), digits.try_cast("decimal(38,0)")
    )
    return F.when(number <= F.lit(Decimal(INTEGER_RANGES["uint64"][1])), number).cast(UINT64)


def floating_number(text: Column) -> Column:
    """Finite text that overflows is wrong; the words for infinity are not."""
    number = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    infinite = F.abs(number) == F.lit(float("inf"))
    sign = F.when(F.startswith(text, F.lit("-")), F.lit("-inf")).otherwise(F.lit("inf"))
    return (
        F.when(F.rlike(text, F.lit(DECIMAL_FLOAT)) | F.rlike(text, F.lit(HEX_FLOAT)), F.when(~infinite, number))
        .when(F.rlike(text, F.lit(INFINITE)), sign.cast("double"))
        .when(F.rlike(text, F.lit(NOT_A_NUMBER)), F.lit(float("nan")))
    )


def truth(text: Column) -> Column:
    return F.when(text.isin(TRUE_TEXT), F.lit(True)).when(text.isin(FALSE_TEXT), F.lit(False))


def _instant(text: Column) -> Column:
    # Digits beyond microseconds are cut; a comma may separate the fraction.
    tidy = F.regexp_replace(F.replace(text, F.lit(","), F.lit(".")), r"(\.[0-9]{6})[0-9]+", "$1")
    return tidy.try_cast("timestamp")


def zoned_instant(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit(RFC3339)), _instant(text))


def micros_instant(text: Column) -> Column:
    return F.timestamp_micros(signed_number(trimmed(text)))


def flexible_instant(text: Column) -> Column:
    """Whole numbers are microseconds; other text is a date-time or a date."""
    text = trimmed(text)
    return F.coalesce(
        F.timestamp_micros(signed_number(text)),
        F.when(F.rlike(text, F.lit(ZONED)), _instant(text)),
        F.when(
            F.rlike(text, F.lit(ZONELESS)),
            _instant(
                F.when(F.length(text) > 10, F.concat(text, F.lit("Z"))).otherwise(
                    F.concat(text, F.lit("T00:00:00Z"))
                )
            ),
        ),
    )


# Transform names.
_TRANSFORMS = {
    "": lambda text: text,
    "string": lambda text: text,
    "int": signed_number,
    "int64": signed_number,
    "uint64": unsigned_number,
    "float64": floating_number,
    "bool": truth,
    "rfc3339": zoned_instant,
    "timestamp64_us": micros_instant,
    "timestamp64": flexible_instant,
}


def check_transform(name: str | None) -> str:
    kind = (name or "").strip()
    if kind not in _TRANSFORMS:
        raise ValueError(f"unsupported transform {name!r}")
    return kind


def transform(name: str | None, text: Column) -> Parsed:
    """Apply the named transform; an unknown name fails while planning."""
    return _checked(text, _TRANSFORMS[check_transform(name)](text))
