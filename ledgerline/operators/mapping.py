"""Declarative field mapping from records to typed table rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.coerce import VALUE_TYPES, coerce, transform_fits
from ledgerline.functions.fields import get_field, log_timestamp_us, payload_fingerprint
from ledgerline.functions.text import scalar_text
from ledgerline.functions.transforms import Parsed, check_transform, transform
from ledgerline.schema import TableColumn


@dataclass(frozen=True)
class FieldMapping:
    source: str
    destination: str
    default: str | None = None
    transform: str = ""


# The mapping used when none is given.
DEFAULT_MAPPING = [
    FieldMapping("message", "message"),
    FieldMapping("seqno", "seqno", transform="int64"),
    FieldMapping("parsed.P_DTTM", "log_dttm", transform="timestamp64"),
    FieldMapping("parsed.P_SERVICE", "service_name"),
    FieldMapping("parsed.P_LEVEL", "log_level"),
    FieldMapping("parsed.P_MESSAGE", "log_message"),
    FieldMapping("syslog_identifier", "syslog_id"),
    FieldMapping("log_timestamp_us", "log_timestamp_us", transform="timestamp64_us"),
    FieldMapping("message_cityhash64", "message_hash", transform="uint64"),
    FieldMapping("priority", "priority", transform="int"),
    FieldMapping("client_id", "client_id"),
]

# The mapping for the log table of ``schema.LOG_TABLE``.
LOG_TABLE_MAPPING = [
    FieldMapping("client_id", "hostname"),
    FieldMapping("systemd_unit", "unit"),
    FieldMapping("log_timestamp_us", "ts_log", transform="timestamp64_us"),
    FieldMapping("message_cityhash64", "message_hash", transform="uint64"),
    FieldMapping("seqno", "seqno", transform="int64"),
    FieldMapping("realtime_ts", "ts_orig", transform="timestamp64_us"),
    FieldMapping("parsed.P_SERVICE", "service", default="unknown"),
    FieldMapping("parsed.P_LEVEL", "level", default="unknown"),
    FieldMapping("parsed.P_DBNAME", "dbname", default="-"),
    FieldMapping("message", "msg"),
    FieldMapping("parsed.P_MESSAGE", "msg"),
]

FINGERPRINT_SOURCE = "message_cityhash64"


def check_mapping(
    mapping: list[FieldMapping], columns: list[TableColumn], require_all: bool = False
) -> None:
    """Reject a mapping the table can never take, before any job runs."""
    by_name = {c.name: c for c in columns}
    for entry in mapping:
        name = entry.destination.strip()
        if not name:
            raise ValueError(f"mapping {entry.source}: empty destination")
        if name not in by_name:
            raise ValueError(
                f"mapping {entry.source} -> {name}: destination column not found in table schema"
            )
        if not transform_fits(entry.transform, by_name[name].type):
            raise ValueError(
                f"mapping {entry.source} -> {name}: transform {entry.transform!r} is incompatible "
                f"with column type {by_name[name].type}"
            )
    if require_all:
        mapped = {m.destination.strip() for m in mapping}
        for column in columns:
            if not column.nullable and column.name not in mapped:
                raise ValueError(f"missing required column {column.name!r}")


def _source(path: str, client: str) -> Column:
    if path == "client_id":
        return F.nullif(F.col(client), F.lit(""))
    if path == "log_timestamp_us":
        return log_timestamp_us().cast("string")
    if path == FINGERPRINT_SOURCE:
        return payload_fingerprint().cast("string")
    return get_field(path)


def _entry_text(entry: FieldMapping, client: str) -> Column:
    text = _source(entry.source, client)
    return text if entry.default is None else F.coalesce(text, F.lit(entry.default))


def _native(entry: FieldMapping) -> Parsed | None:
    """Numbers that need no trip through text: same value, no parsing."""
    kind = check_transform(entry.transform)
    plain = entry.default is None
    if kind in ("int", "int64") and plain and entry.source in ("seqno", "priority", "realtime_ts"):
        return Parsed(F.col(entry.source).cast("bigint"), F.lit(False))
    if kind in ("timestamp64_us", "timestamp64"):
        if entry.source == "log_timestamp_us":
            return Parsed(F.timestamp_micros(log_timestamp_us()), F.lit(False))
        if plain and entry.source == "realtime_ts":
            return Parsed(F.timestamp_micros(F.col("realtime_ts")), F.lit(False))
    if kind == "uint64" and entry.source == FINGERPRINT_SOURCE:
        return Parsed(payload_fingerprint(), F.lit(False))
    return None


def map_entry(entry: FieldMapping, client: str = "client_id") -> Parsed:
    native = _native(entry)
    return native if native is not None else transform(entry.transform, _entry_text(entry, client))


def map_fields(
    df: DataFrame,
    mapping: list[FieldMapping] | None = None,
    columns: list[TableColumn] | None = None,
    client: str = "client_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """Map records to destination columns in one projection.

    For each destination the last entry that yields a value wins. A value that
    does not fit its transform sets ``map_error``; one that does not fit the
    declared column type sets ``encode_error``. Both name the first such entry.
    """
    mapping = DEFAULT_MAPPING if mapping is None else mapping
    if columns is not None:
        check_mapping(mapping, columns)
    types = {c.name: c for c in columns or []}
    by_destination: dict[str, list[tuple[FieldMapping, Parsed]]] = {}
    map_errors: list[Column] = []
    encode_errors: list[Column] = []
    for entry in mapping:
        parsed = map_entry(entry, client)
        name = entry.destination.strip()
        label = f"map {entry.source} -> {name}: invalid value "
        text = F.coalesce(_entry_text(entry, client), F.lit(""))
        if not (parsed.error is None or _native(entry) is not None):
            map_errors.append(F.when(parsed.error, F.concat(F.lit(label), F.to_json(F.array(text)))))
        by_destination.setdefault(name, []).append((entry, parsed))

    outputs = []
    for name, entries in by_destination.items():
        kinds = {VALUE_TYPES[check_transform(e.transform)].simpleString() for e, _ in entries}
        values = []
        for entry, parsed in reversed(entries):
            kind = VALUE_TYPES[check_transform(entry.transform)]
            if name in types:
                values.append(parsed.value)
            elif len(kinds) == 1:
                values.append(parsed.value)
            else:
                values.append(scalar_text(parsed.value, kind))
        if name in types:
            outputs.append(_to_column(name, entries, types[name], encode_errors).alias(name))
        else:
            outputs.append(F.coalesce(*values).alias(name))
    no_error = F.lit(None).cast("string")
    return df.select(
        *[F.col(k) for k in keep or []],
        *outputs,
        F.coalesce(*map_errors, no_error).alias("map_error"),
        F.coalesce(*encode_errors, no_error).alias("encode_error"),
    )


def _to_column(name, entries, column: TableColumn, encode_errors: list[Column]) -> Column:
    """The winning entry's value in the column type; only the winner is encoded."""
    value = F.lit(None).cast(column.spark_type)
    error = F.lit(False)
    for entry, parsed in entries:
        kind = VALUE_TYPES[check_transform(entry.transform)]
        fitted = coerce(parsed.value, kind, column.type)
        present = parsed.value.isNotNull()
        if len(entries) == 1:
            value, error = fitted.value, fitted.error
        else:
            value = F.when(present, fitted.value).otherwise(value)
            error = F.when(present, fitted.error).otherwise(error)
    encode_errors.append(F.when(error, F.lit(f"encode {name}: value does not fit {column.type}")))
    return value


def conform_schema(df: DataFrame, columns: list[TableColumn], keep: list[str] | None = None) -> DataFrame:
    """Exactly the table's columns in order, plus ``encode_error``.

    Missing nullable columns become null, missing required values an error,
    other columns are dropped.
    """
    present = set(df.columns)
    outputs, errors = [], []
    if "encode_error" in present:
        errors.append(F.col("encode_error"))
    for column in columns:
        if column.name in present:
            value = F.col(column.name)
            if df.schema[column.name].dataType != column.spark_type:
                fitted = coerce(value, df.schema[column.name].dataType, column.type)
                errors.append(
                    F.when(fitted.error, F.lit(f"encode {column.name}: value does not fit {column.type}"))
                )
                value = fitted.value
        else:
            value = F.lit(None).cast(column.spark_type)
        if not column.nullable:
            source = F.col(column.name) if column.name in present else value
            errors.append(F.when(source.isNull(), F.lit(f'missing required column "{column.name}"')))
        outputs.append(value.alias(column.name))
    return df.select(
        *[F.col(k) for k in keep or []],
        *outputs,
        F.coalesce(*errors, F.lit(None).cast("string")).alias("encode_error"),
    )
