"""Queries for field access, transforms, coercions and text."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import coerce, text, transforms
from ledgerline.functions.fields import (
    envelope_json_bytes,
    get_field,
    log_timestamp_us,
    payload_fingerprint,
    record_json_bytes,
)
from ledgerline.functions.parse import parse_message, parse_unit
from ledgerline.operators.mapping import LOG_TABLE_MAPPING, FieldMapping, conform_schema, map_fields
from ledgerline.plans import views
from ledgerline.plans.registry import query
from ledgerline.plans.views import duckdb_ctes, table
from ledgerline.schema import LOG_TABLE, TableColumn

WITH_RECORDS = duckdb_ctes("records")
WITH_VALUES = duckdb_ctes("values")

# The message pattern on a record's text, for the oracle side.
RE = r"'^(?:([^ ]+)\s+)?:([^ ]+)\s+([^ ]+):\s+(.*)$'"
RE_UNIT = r"'^[^@]+@([^.@]+)\.service$'"


@query(
    "get_field",
    WITH_RECORDS
    + """
SELECT seqno, nullif(message, '') AS message, CAST(seqno AS VARCHAR) AS seqno_text,
       CAST(priority AS VARCHAR) AS priority, nullif(syslog_identifier, '') AS syslog_identifier,
       nullif(systemd_unit, '') AS systemd_unit, CAST(realtime_ts AS VARCHAR) AS realtime_ts,
       fields_json ->> 'k' AS field_k, CAST(NULL AS VARCHAR) AS field_missing, CAST(NULL AS VARCHAR) AS unknown
FROM v_records""",
)
def q_get_field(spark, sf):
    paths = {
        "message": "message", "seqno": "seqno_text", "priority": "priority",
        "syslog_identifier": "syslog_identifier", "systemd_unit": "systemd_unit",
        "realtime_ts": "realtime_ts", "fields.k": "field_k", "fields.missing": "field_missing",
        "unknown": "unknown",
    }
    return views.records(spark, sf).select(
        "seqno", *[get_field(path).alias(name) for path, name in paths.items()]
    )


@query("log_timestamp_us", WITH_RECORDS + " SELECT seqno, realtime_ts AS log_timestamp_us FROM v_records")
def q_log_timestamp(spark, sf):
    return views.records(spark, sf).select("seqno", log_timestamp_us().alias("log_timestamp_us"))


FINGERPRINT_JSON = """concat('{"fields":{"k":', CAST(to_json(fields_json ->> 'k') AS VARCHAR), '},"message":',
       CAST(to_json(message) AS VARCHAR), ',"priority":', CAST(priority AS VARCHAR),
       ',"realtime_ts":', CAST(realtime_ts AS VARCHAR), ',"seqno":', CAST(seqno AS VARCHAR),
       ',"syslog_identifier":', CAST(to_json(syslog_identifier) AS VARCHAR),
       ',"systemd_unit":', CAST(to_json(systemd_unit) AS VARCHAR), '}')"""


def hash_sql(payload: str) -> str:
    return f"CAST(CAST(concat('0x', substr(md5({payload}), 1, 16)) AS UBIGINT) AS VARCHAR)"


@query(
    "payload_fingerprint",
    WITH_RECORDS + f" SELECT seqno, {hash_sql(FINGERPRINT_JSON)} AS fingerprint FROM v_records",
)
def q_fingerprint(spark, sf):
    df = views.records(spark, sf).withColumn("parsed", F.lit(None).cast("map<string,string>"))
    return df.select("seqno", payload_fingerprint().cast("string").alias("fingerprint"))


@query(
    "parse_message",
    WITH_RECORDS
    + f"""
SELECT seqno, regexp_matches(message, {RE}) AS matched,
       nullif(regexp_extract(message, {RE}, 1), '') AS p_dttm,
       nullif(regexp_extract(message, {RE}, 2), '') AS p_service,
       nullif(regexp_extract(message, {RE}, 3), '') AS p_level,
       nullif(regexp_extract(message, {RE}, 4), '') AS p_message
FROM v_records""",
)
def q_parse_message(spark, sf):
    df = parse_message(views.records(spark, sf), views.MESSAGE_PATTERN)
    return df.select("seqno", "matched", *_parsed("P_DTTM", "P_SERVICE", "P_LEVEL", "P_MESSAGE"))


def _parsed(*names):
    return [F.try_element_at("parsed", F.lit(n)).alias(n.lower()) for n in names]


@query(
    "parse_unit",
    WITH_RECORDS
    + f" SELECT seqno, nullif(regexp_extract(systemd_unit, {RE_UNIT}, 1), '') AS p_dbname FROM v_records",
)
def q_parse_unit(spark, sf):
    return parse_unit(views.records(spark, sf), views.UNIT_PATTERN).select("seqno", *_parsed("P_DBNAME"))


@query(
    "escape_tsv",
    """SELECT doc_id AS id, 'document' AS origin,
       replace(replace(replace(text, chr(9), '\\t'), chr(10), '\\n'), chr(13), '\\r') AS cell FROM documents
UNION ALL
SELECT page_id, 'page',
       replace(replace(replace(html, chr(9), '\\t'), chr(10), '\\n'), chr(13), '\\r') FROM pages""",
)
def q_escape_tsv(spark, sf):
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.lit("document").alias("origin"), text.escape_tsv(F.col("text")).alias("cell")
    )
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.lit("page").alias("origin"), text.escape_tsv(F.col("html")).alias("cell")
    )
    return documents.unionByName(pages)


@query(
    "stringify_cell",
    """SELECT event_id, CAST(event_id AS VARCHAR) AS number_cell,
       concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'),
              CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE
                rtrim(concat('.', lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0')), '0') END, 'Z') AS time_cell,
       CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS flag_cell,
       CASE WHEN user_id % 3 = 0 THEN '' ELSE event_type END AS text_cell,
       concat(CAST(event_id AS VARCHAR), '.25') AS decimal_cell,
       event_type AS bytes_cell
FROM events""",
)
def q_stringify_cell(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id",
        F.col("event_id").alias("number_cell"),
        F.col("ts").cast("timestamp").alias("time_cell"),
        (F.col("user_id") % 2 == 0).alias("flag_cell"),
        F.when(F.col("user_id") % 3 != 0, F.col("event_type")).alias("text_cell"),
        (F.col("event_id").cast("decimal(18,2)") + F.lit("0.25").cast("decimal(3,2)")).cast("decimal(20,2)").alias("decimal_cell"),
        F.encode("event_type", "UTF-8").alias("bytes_cell"),
    )
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select("event_id", *[text.stringify_cell(F.col(c), types[c]).alias(c) for c in df.columns[1:]])


RECORD_JSON = """concat('{"message":', CAST(to_json(text) AS VARCHAR), ',"seqno":', CAST(doc_id AS VARCHAR),
         ',"syslog_identifier":', CAST(to_json(source) AS VARCHAR), '}')"""


@query(
    "json_size",
    f"""SELECT doc_id, record_bytes,
       CAST(13 + 5 + 14 + 17 + 4 + 20 + 4 + 11 + 1 + 2 + record_bytes AS BIGINT) AS envelope_bytes
FROM (SELECT doc_id,
       CAST(strlen({RECORD_JSON})
         + 5 * (length(text) - length(replace(replace(replace(text, '<', ''), '>', ''), '&', '')))
         + 3 * (length(text) - length(replace(replace(text, chr(8232), ''), chr(8233), ''))) AS BIGINT) AS record_bytes
  FROM documents) d""",
)
def q_json_size(spark, sf):
    df = table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("message"),
        F.lit(None).cast("map<string,string>").alias("parsed"),
        F.col("doc_id").alias("seqno"),
        F.lit(None).cast("int").alias("priority"),
        F.col("source").alias("syslog_identifier"),
        F.lit("").alias("systemd_unit"),
        F.lit(None).cast("bigint").alias("realtime_ts"),
        F.lit(None).cast("map<string,string>").alias("fields"),
    )
    sized = df.select("doc_id", record_json_bytes().alias("record_bytes"))
    return sized.withColumn(
        "envelope_bytes",
        envelope_json_bytes(F.lit("cli"), F.lit("p0"), F.lit("p1"), F.col("record_bytes") + 2),
    )


# --- transforms -----------------------------------------------------------

INT_SQL = "CASE WHEN regexp_matches(x, '^[+-]?[0-9]+$') THEN TRY_CAST(ltrim(x, '+') AS BIGINT) END"
UINT_SQL = "CASE WHEN regexp_matches(x, '^[0-9]+$') THEN CAST(TRY_CAST(x AS UBIGINT) AS VARCHAR) END"
FLOAT_SQL = "CASE WHEN regexp_matches(x, '^[+-]?[0-9]+([.][0-9]*)?([eE][+-]?[0-9]+)?$') THEN TRY_CAST(x AS DOUBLE) END"
BOOL_SQL = (
    "CASE WHEN x IN ('1','t','T','TRUE','true','True') THEN true "
    "WHEN x IN ('0','f','F','FALSE','false','False') THEN false END"
)
ZONED_SQL = r"'^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$'"
PLAIN_SQL = r"'^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?)?$'"
RFC_SQL = f"CASE WHEN contains(x, 'T') AND regexp_matches(x, {ZONED_SQL}) THEN epoch_us(TRY_CAST(x AS TIMESTAMPTZ)) END"
MICROS_SQL = "CASE WHEN regexp_matches(trim(x), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(x) AS BIGINT) END"
FLEX_SQL = (
    f"coalesce({MICROS_SQL}, CASE WHEN regexp_matches(trim(x), {ZONED_SQL}) "
    f"THEN epoch_us(TRY_CAST(trim(x) AS TIMESTAMPTZ)) WHEN regexp_matches(trim(x), {PLAIN_SQL}) "
    f"THEN epoch_us(TRY_CAST(trim(x) AS TIMESTAMP)) END)"
)


def _parse_oracle(source: str, sql: str) -> str:
    return (
        WITH_VALUES
        + f""" SELECT event_id, value, raw IS NOT NULL AND value IS NULL AS error
FROM (SELECT event_id, x AS raw, {sql} AS value FROM (SELECT event_id, {source} AS x FROM v_values) v) p"""
    )


def _show(value, kind):
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    return value.cast("string") if isinstance(kind, T.DecimalType) else value


def _register_transform(key: str, name: str, source: str, sql: str) -> None:
    @query(key, _parse_oracle(source, sql))
    def run(spark, sf):
        parsed = transforms.transform(name, F.col(source))
        kind = coerce.VALUE_TYPES[name]
        return views.values(spark, sf).select(
            "event_id", _show(parsed.value, kind).alias("value"), parsed.error.alias("error")
        )


_register_transform("tf_string", "string", "raw", "x")
_register_transform("tf_int", "int", "raw", INT_SQL)
_register_transform("tf_int64", "int64", "raw", INT_SQL)
_register_transform("tf_uint64", "uint64", "raw", UINT_SQL)
_register_transform("tf_float64", "float64", "raw", FLOAT_SQL)
_register_transform("tf_bool", "bool", "flag", BOOL_SQL)
_register_transform("tf_rfc3339", "rfc3339", "moment", RFC_SQL)
_register_transform("tf_timestamp64_us", "timestamp64_us", "moment", MICROS_SQL)
_register_transform("tf_timestamp64", "timestamp64", "moment", FLEX_SQL)


# --- coercions ------------------------------------------------------------


def _coerced(spark, sf, cases):
    """``cases`` maps an output name to (source column, its type, column type)."""
    df = views.values(spark, sf).withColumns(
        {
            "whole": F.col("event_id") * 37 - 1000,
            "half": F.col("event_id") / 2,
            "flagged": F.col("event_id") % 2 == 0,
            "at": F.col("ts").cast("timestamp"),
        }
    )
    out = [F.col("event_id")]
    for name, (source, kind, column_type) in cases.items():
        fitted = coerce.coerce(F.col(source), kind, column_type)
        shown = _show(fitted.value, TableColumn("x", column_type).spark_type)
        out += [shown.alias(name), fitted.error.alias(f"{name}_error")]
    return df.select(*out)


def _coerce_oracle(cases: dict[str, tuple[str, str]]) -> str:
    """``cases`` maps a name to (source expression, value expression over x)."""
    inner = ", ".join(f"{source} AS {name}_raw" for name, (source, _) in cases.items())
    mid = ", ".join(
        f"{name}_raw, (SELECT {sql} FROM (SELECT {name}_raw AS x) s) AS {name}" for name, (_, sql) in cases.items()
    )
    outer = ", ".join(f"{name}, {name}_raw IS NOT NULL AND {name} IS NULL AS {name}_error" for name in cases)
    return WITH_VALUES + f" SELECT event_id, {outer} FROM (SELECT event_id, {mid} FROM (SELECT event_id, {inner} FROM v_values) a) b"


STRING, LONG, DOUBLE, BOOL, TIME = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()
WHOLE, HALF = "event_id * 37 - 1000", "event_id / 2"


def _ranged(low: int, high: int, sql: str) -> str:
    return f"CASE WHEN ({sql}) BETWEEN {low} AND {high} THEN ({sql}) END"


@query(
    "to_text",
    _coerce_oracle(
        {
            "from_number": (WHOLE, "CAST(x AS VARCHAR)"),
            "from_flag": ("event_id % 2 = 0", "CASE WHEN x THEN 'true' ELSE 'false' END"),
            "from_text": ("raw", "x"),
        }
    ),
)
def q_to_text(spark, sf):
    return _coerced(
        spark, sf,
        {"from_number": ("whole", LONG, "utf8"), "from_flag": ("flagged", BOOL, "utf8"), "from_text": ("raw", STRING, "json")},
    )


@query(
    "to_binary",
    WITH_VALUES
    + """ SELECT event_id, hex(CAST(raw AS BLOB)) AS from_text, false AS from_text_error,
       CAST(NULL AS VARCHAR) AS from_number, true AS from_number_error FROM v_values""",
)
def q_to_binary(spark, sf):
    out = _coerced(spark, sf, {"from_text": ("raw", STRING, "bytes"), "from_number": ("whole", LONG, "bytes")})
    return out.withColumns({"from_text": F.hex("from_text"), "from_number": F.hex("from_number")})


@query(
    "to_boolean",
    _coerce_oracle(
        {
            "from_flag": ("event_id % 2 = 0", "x"),
            "from_text": ("flag", BOOL_SQL.replace("x IN", "trim(x) IN")),
            "from_number": (WHOLE, "CASE WHEN x IS NULL THEN true END"),
        }
    ),
)
def q_to_boolean(spark, sf):
    return _coerced(
        spark, sf,
        {"from_flag": ("flagged", BOOL, "bool"), "from_text": ("flag", STRING, "bool"), "from_number": ("whole", LONG, "bool")},
    )


INT_TRIMMED = INT_SQL.replace("(x", "(trim(x)")


@query(
    "to_signed",
    _coerce_oracle(
        {
            "byte": (WHOLE, "CAST(" + _ranged(-128, 127, "x") + " AS TINYINT)"),
            "short": (WHOLE, "CAST(" + _ranged(-32768, 32767, "x") + " AS SMALLINT)"),
            "from_text": ("raw", INT_TRIMMED),
            "from_half": (HALF, "CASE WHEN x = floor(x) THEN CAST(x AS INTEGER) END"),
        }
    ),
)
def q_to_signed(spark, sf):
    return _coerced(
        spark, sf,
        {
            "byte": ("whole", LONG, "int8"), "short": ("whole", LONG, "int16"),
            "from_text": ("raw", STRING, "int64"), "from_half": ("half", DOUBLE, "int32"),
        },
    )


@query(
    "to_unsigned",
    _coerce_oracle(
        {
            "byte": (WHOLE, "CAST(" + _ranged(0, 255, "x") + " AS SMALLINT)"),
            "short": (WHOLE, "CAST(" + _ranged(0, 65535, "x") + " AS INTEGER)"),
            "word": (WHOLE, _ranged(0, 4294967295, "x")),
            "from_text": ("raw", UINT_SQL.replace("(x", "(trim(x)")),
            "from_half": (HALF, "CASE WHEN x = floor(x) THEN CAST(CAST(x AS BIGINT) AS VARCHAR) END"),
        }
    ),
)
def q_to_unsigned(spark, sf):
    return _coerced(
        spark, sf,
        {
            "byte": ("whole", LONG, "uint8"), "short": ("whole", LONG, "uint16"), "word": ("whole", LONG, "uint32"),
            "from_text": ("raw", STRING, "uint64"), "from_half": ("half", DOUBLE, "uint64"),
        },
    )


@query(
    "to_floating",
    _coerce_oracle(
        {
            "from_number": (WHOLE, "CAST(x AS DOUBLE)"),
            "from_text": ("raw", FLOAT_SQL.replace("(x", "(trim(x)")),
            "from_flag": ("event_id % 2 = 0", "CASE WHEN x IS NULL THEN CAST(0 AS DOUBLE) END"),
        }
    ),
)
def q_to_floating(spark, sf):
    return _coerced(
        spark, sf,
        {"from_number": ("whole", LONG, "double"), "from_text": ("raw", STRING, "double"), "from_flag": ("flagged", BOOL, "double")},
    )


@query(
    "to_timestamp",
    _coerce_oracle(
        {
            "from_time": ("ts", "epoch_us(x)"),
            "from_number": (WHOLE, "x"),
            "from_text": ("moment", FLEX_SQL),
            "from_flag": ("event_id % 2 = 0", "CASE WHEN x IS NULL THEN CAST(0 AS BIGINT) END"),
        }
    ),
)
def q_to_timestamp(spark, sf):
    return _coerced(
        spark, sf,
        {
            "from_time": ("at", TIME, "timestamp64"), "from_number": ("whole", LONG, "timestamp64"),
            "from_text": ("moment", STRING, "timestamp64"), "from_flag": ("flagged", BOOL, "timestamp64"),
        },
    )


# --- mapping --------------------------------------------------------------

SAMPLE_MAPPING = [
    FieldMapping("client_id", "hostname"),
    FieldMapping("seqno", "seqno", transform="int64"),
    FieldMapping("realtime_ts", "ts_orig", transform="timestamp64_us"),
    FieldMapping("parsed.P_SERVICE", "service", default="unknown"),
    FieldMapping("parsed.P_LEVEL", "level", default="unknown"),
    FieldMapping("syslog_identifier", "ident"),
    FieldMapping("message", "msg"),
    FieldMapping("parsed.P_MESSAGE", "msg"),
    FieldMapping("fields.k", "small", transform="int"),
    FieldMapping("syslog_identifier", "number", transform="int64"),
]


@query(
    "map_fields",
    WITH_RECORDS
    + f"""
SELECT client_id AS hostname, seqno, realtime_ts AS ts_orig,
       coalesce(nullif(regexp_extract(message, {RE}, 2), ''), 'unknown') AS service,
       coalesce(nullif(regexp_extract(message, {RE}, 3), ''), 'unknown') AS level,
       nullif(syslog_identifier, '') AS ident,
       coalesce(nullif(regexp_extract(message, {RE}, 4), ''), nullif(message, '')) AS msg,
       CAST(fields_json ->> 'k' AS BIGINT) AS small, CAST(NULL AS BIGINT) AS number,
       CASE WHEN syslog_identifier <> '' THEN
         concat('map syslog_identifier -> number: invalid value ["', syslog_identifier, '"]') END AS map_error
FROM v_records""",
)
def q_map_fields(spark, sf):
    parsed = parse_message(views.records(spark, sf), views.MESSAGE_PATTERN)
    out = map_fields(parsed, SAMPLE_MAPPING)
    return out.withColumn("ts_orig", F.unix_micros("ts_orig")).drop("encode_error")


@query(
    "conform_schema",
    WITH_RECORDS
    + """
SELECT CAST(NULL AS BIGINT) AS ts_orig, CAST(NULL AS VARCHAR) AS dbname, CAST(NULL AS VARCHAR) AS service,
       CASE WHEN priority < 4 THEN 'high' END AS level, nullif(message, '') AS msg, systemd_unit AS unit, seqno,
       realtime_ts AS ts_log, CAST(seqno AS VARCHAR) AS message_hash, nullif(syslog_identifier, '') AS hostname,
       CASE WHEN syslog_identifier = '' THEN 'missing required column "hostname"' END AS encode_error
FROM v_records""",
)
def q_conform_schema(spark, sf):
    mapped = views.records(spark, sf).select(
        F.when(F.col("priority") < 4, "high").alias("level"),
        F.nullif("message", F.lit("")).alias("msg"),
        F.col("systemd_unit").alias("unit"),
        "seqno",
        F.timestamp_micros("realtime_ts").alias("ts_log"),
        F.col("seqno").alias("message_hash"),
        F.nullif("syslog_identifier", F.lit("")).alias("hostname"),
        F.lit("dropped").alias("extra"),
    )
    return show_rows(conform_schema(mapped, LOG_TABLE))


def show_rows(df):
    """Times as microseconds and hashes as text, so that both engines compare."""
    return df.withColumns(
        {
            "ts_orig": F.unix_micros("ts_orig"),
            "ts_log": F.unix_micros("ts_log"),
            "message_hash": F.col("message_hash").cast("string"),
        }
    )


__all__ = ["LOG_TABLE_MAPPING", "hash_sql", "show_rows"]
