"""Exported journal entries (one JSON object per line) as records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.transforms import SIGNED

# Journal field names.
MESSAGE = "MESSAGE"
PRIORITY = "PRIORITY"
IDENTIFIER = "SYSLOG_IDENTIFIER"
UNIT = "_SYSTEMD_UNIT"
REALTIME = "__REALTIME_TIMESTAMP"
CURSOR = "__CURSOR"
SEQUENCE = "__SEQNUM"
HOST = "_HOSTNAME"
# Time from the entry header, used when the realtime field is missing or bad.
HEADER_TIME = "__HEADER_TIMESTAMP"

ENTRY_SCHEMA = "map<string,string>"


def _entry(name: str) -> Column:
    return F.try_element_at(F.col("entry"), F.lit(name))


def _bytes_text(value: Column) -> Column:
    """The text of an array of byte values; bad UTF-8 shows as replacement characters. Null if it is none."""
    numbers = F.from_json(value, "array<int>")
    good = (F.size(numbers) > 0) & F.forall(numbers, lambda n: n.isNotNull() & n.between(0, 255))
    packed = F.unhex(F.array_join(F.transform(numbers, lambda n: F.lpad(F.hex(n.cast("long")), 2, "0")), ""))
    return F.when(good, F.make_valid_utf8(packed.cast("string")))


def _array_text(value: Column) -> Column:
    """The text of a field that is exported as an array.

    Values with control characters or bad UTF-8 are arrays of bytes; a repeated
    field is an array of its values, of which the last counts.
    """
    several = F.from_json(value, "array<string>")
    last = F.element_at(several, -1)
    decoded = F.coalesce(_bytes_text(value), F.when(F.size(several) > 0, F.coalesce(_bytes_text(last), last)))
    return F.coalesce(decoded, value)


def _number(text: Column, kind: str) -> Column:
    return F.when(F.rlike(text, F.lit(SIGNED)), text.try_cast(kind))


def read_entries(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse lines into an ``entry`` map; null where a line is unreadable.

    Only lines that may hold an array are parsed again with types, as a text may
    look like an array too.
    """
    plain = F.from_json(value, ENTRY_SCHEMA)
    typed = F.from_json(value, "map<string,variant>")
    kind = lambda name: F.schema_of_variant(F.try_element_at(typed, name))
    decoded = F.transform_values(
        plain, lambda name, text: F.when(F.startswith(kind(name), F.lit("ARRAY")), _array_text(text)).otherwise(text)
    )
    entry = F.when(F.rlike(value, F.lit(r'":\s*\[')), decoded).otherwise(plain)
    return lines.filter(F.btrim(F.col(value)) != "").withColumn("entry", entry)


def skip_unreadable(entries: DataFrame, skipped: Observation | None = None) -> DataFrame:
    """Keep readable entries; ``skipped`` receives ``unreadable`` and ``total``."""
    if skipped is not None:
        entries = entries.observe(
            skipped,
            F.count_if(F.col("entry").isNull()).alias("unreadable"),
            F.count(F.lit(1)).alias("total"),
        )
    return entries.filter(F.col("entry").isNotNull())


def to_records(entries: DataFrame, client_key: str = HOST) -> DataFrame:
    """Known keys become columns; all other keys stay in ``fields``.

    ``entry_seq`` orders a client's entries: the exported sequence number, or
    the one inside the cursor.
    """
    cursor = _entry(CURSOR)
    inside_cursor = F.nullif(F.regexp_extract(cursor, "(?:^|;)i=([0-9a-f]+)", 1), F.lit(""))
    own = [MESSAGE, PRIORITY, IDENTIFIER, UNIT]
    return entries.select(
        F.coalesce(_entry(client_key), F.lit("")).alias("client_id"),
        F.coalesce(
            _number(_entry(SEQUENCE), "bigint"), F.conv(inside_cursor, 16, 10).try_cast("bigint")
        ).alias("entry_seq"),
        F.coalesce(cursor, F.lit("")).alias("cursor"),
        F.coalesce(_entry(MESSAGE), F.lit("")).alias("message"),
        F.lit(None).cast("map<string,string>").alias("parsed"),
        F.lit(None).cast("bigint").alias("seqno"),
        _number(_entry(PRIORITY), "int").alias("priority"),
        F.coalesce(_entry(IDENTIFIER), F.lit("")).alias("syslog_identifier"),
        F.coalesce(_entry(UNIT), F.lit("")).alias("systemd_unit"),
        F.coalesce(_number(_entry(REALTIME), "bigint"), _number(_entry(HEADER_TIME), "bigint")).alias(
            "realtime_ts"
        ),
        # Names with two underscores are the entry's address, not its fields.
        F.map_filter("entry", lambda k, _: ~k.isin(own) & ~F.startswith(k, F.lit("__"))).alias("fields"),
    )


def scan_journal(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    skipped: Observation | None = None,
    client_key: str = HOST,
) -> DataFrame:
    """Records from exported journal files, as a batch or a stream."""
    reader = spark.readStream if streaming else spark.read
    return to_records(skip_unreadable(read_entries(reader.text(path)), skipped), client_key)
