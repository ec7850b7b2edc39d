"""Field access on records: paths, timestamps, fingerprints, wire sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schema import UINT64

# Record paths that are top-level columns.
TEXT_PATHS = ("message", "syslog_identifier", "systemd_unit")
NUMBER_PATHS = ("seqno", "priority", "realtime_ts")


def get_field(path: str) -> Column:
    """A record path as a nullable string.

    Top-level text counts as absent when empty; map values do not.
    """
    if path in TEXT_PATHS:
        return F.nullif(F.col(path), F.lit(""))
    if path in NUMBER_PATHS:
        return F.col(path).cast("string")
    for prefix in ("parsed.", "fields."):
        if path.startswith(prefix) and len(path) > len(prefix):
            return F.try_element_at(F.col(prefix[:-1]), F.lit(path[len(prefix) :]))
    return F.lit(None).cast("string")


def log_timestamp_us(realtime: str = "realtime_ts") -> Column:
    """The record's own time, else the time of the query, in microseconds."""
    return F.coalesce(F.col(realtime), F.unix_micros(F.current_timestamp()))


def sorted_map(column: Column) -> Column:
    """The map with its keys in order; null when empty."""
    return F.when(
        F.size(column) > 0, F.map_from_entries(F.array_sort(F.map_entries(column)))
    )


def payload_fingerprint(seqno: bool = True) -> Column:
    """64-bit hash of the whole record, as an unsigned number in decimal(20,0).

    The same record always yields the same value, whatever the order of its
    map keys, so a replayed record lands on the same table key.
    """
    payload = F.to_json(
        F.struct(
            sorted_map(F.col("fields")).alias("fields"),
            F.col("message"),
            sorted_map(F.col("parsed")).alias("parsed"),
            F.col("priority"),
            F.col("realtime_ts"),
            *([F.col("seqno")] if seqno else []),
            F.col("syslog_identifier"),
            F.col("systemd_unit"),
        )
    )
    return F.conv(F.substring(F.md5(payload), 1, 16), 16, 10).cast(UINT64)


def json_text_bytes(text: Column) -> Column:
    """UTF-8 length of a JSON string literal, with ``<``, ``>``, ``&`` and the
    two Unicode line separators written as six-byte escapes."""
    return F.octet_length(F.to_json(F.array(text))) - 2 + _escape_extra(text)


def _escape_extra(text: Column) -> Column:
    plain = F.translate(text, "<>&\u2028\u2029", "")
    angle = F.length(text) - F.length(F.translate(text, "<>&", ""))
    separators = F.length(text) - F.length(plain) - angle
    return (angle * 5 + separators * 3).cast("int")


def record_json_bytes() -> Column:
    """Byte length of one record as JSON; absent and empty members are left out."""
    text = {
        p: F.when(F.col(p) != "", F.col(p)) for p in ("message", *TEXT_PATHS[1:])
    }
    document = F.to_json(
        F.struct(
            text["message"].alias("message"),
            F.when(F.size("parsed") > 0, F.col("parsed")).alias("parsed"),
            F.col("seqno"),
            F.col("priority"),
            text["syslog_identifier"].alias("syslog_identifier"),
            text["systemd_unit"].alias("systemd_unit"),
            F.col("realtime_ts"),
            F.when(F.size("fields") > 0, F.col("fields")).alias("fields"),
        )
    )
    return (F.octet_length(document) + _escape_extra(document)).cast("bigint")


# Byte lengths of the envelope's constant parts,
# {"client_id":  ,"reset":false  ,"next_position":  ,"records":  }
ENVELOPE_BYTES = 13 + 14 + 17 + 11 + 1
# ,"current_position":
CURRENT_POSITION_BYTES = 20


def envelope_json_bytes(client: Column, current: Column, next_: Column, array_bytes: Column) -> Column:
    """Byte length of a whole batch request around a records array."""
    return (
        F.lit(ENVELOPE_BYTES)
        + json_text_bytes(client)
        + json_text_bytes(next_)
        + F.when(current != "", json_text_bytes(current) + CURRENT_POSITION_BYTES).otherwise(0)
        + array_bytes
    ).cast("bigint")
