"""Queries for sources, sinks and the end-to-end pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.parse import parse_record
from ledgerline.operators.batching import ordered_list
from ledgerline.operators.mapping import LOG_TABLE_MAPPING
from ledgerline.plans import views
from ledgerline.plans.pipelines import (
    IngestSettings,
    export_query,
    ingest_batch,
    serve_batches,
    to_table_rows,
)
from ledgerline.plans.registry import query
from ledgerline.plans.rows import BODY, FIRST_LINE, FOLD, MERGED, ROTATED
from ledgerline.plans.scalars import RE, RE_UNIT, hash_sql, show_rows
from ledgerline.plans.views import duckdb_ctes, table
from ledgerline.schema import LOG_TABLE
from ledgerline.session import scratch_path, stage
from ledgerline.sinks.dated import DATE, scan_dated, upsert_dated
from ledgerline.sinks.tables import append_rows
from ledgerline.sinks.tsv import read_tsv_zstd, write_tsv, write_tsv_zstd
from ledgerline.sources.batches import batch_records, scan_batches
from ledgerline.sources.journal import read_entries, scan_journal, skip_unreadable, to_records
from ledgerline.sources.logtable import scan_log_table

WITH_RECORDS = duckdb_ctes("records")
WITH_KEPT = duckdb_ctes("kept")


# --- sources --------------------------------------------------------------


def journal_lines(spark, sf):
    """Journal export lines; some priorities, times or whole lines are bad."""
    r = views.records(spark, sf)
    entry = F.to_json(
        F.struct(
            F.col("message").alias("MESSAGE"),
            F.when(F.col("priority") == 5, "notice").otherwise(F.col("priority").cast("string")).alias("PRIORITY"),
            F.col("syslog_identifier").alias("SYSLOG_IDENTIFIER"),
            F.col("systemd_unit").alias("_SYSTEMD_UNIT"),
            F.when(F.col("priority") != 3, F.col("realtime_ts").cast("string")).alias("__REALTIME_TIMESTAMP"),
            (F.col("realtime_ts") + 1).cast("string").alias("__HEADER_TIMESTAMP"),
            F.col("cursor").alias("__CURSOR"),
            F.col("seqno").cast("string").alias("__SEQNUM"),
            F.col("client_id").alias("_HOSTNAME"),
            F.col("fields")["k"].alias("K"),
        )
    )
    broken = F.concat(F.lit('{"MESSAGE": "'), F.col("cursor"))
    return r.select(F.when(F.col("message") == "", broken).otherwise(entry).alias("value"))


JOURNAL_ROWS = """SELECT client_id, seqno AS entry_seq, cursor, message,
       CASE WHEN priority = 5 THEN NULL ELSE priority END AS priority, syslog_identifier, systemd_unit,
       CASE WHEN priority = 3 THEN realtime_ts + 1 ELSE realtime_ts END AS realtime_ts,
       fields_json ->> 'k' AS field_k, client_id AS field_host, 2 AS n_fields
FROM v_records WHERE message <> ''"""


def _show_journal(df):
    return df.select(
        "client_id", "entry_seq", "cursor", "message", "priority", "syslog_identifier", "systemd_unit", "realtime_ts",
        F.col("fields")["K"].alias("field_k"), F.col("fields")["_HOSTNAME"].alias("field_host"),
        F.size("fields").alias("n_fields"),
    )


@query("scan_journal", WITH_RECORDS + " " + JOURNAL_ROWS)
def q_scan_journal(spark, sf):
    path = scratch_path(spark, "journal")
    journal_lines(spark, sf).write.text(path)
    return _show_journal(scan_journal(spark, path))


@query("skip_unreadable", WITH_RECORDS + " " + JOURNAL_ROWS)
def q_skip_unreadable(spark, sf):
    return _show_journal(to_records(skip_unreadable(read_entries(journal_lines(spark, sf)))))


def batch_lines(spark, sf, keep=()):
    """One JSON line per envelope of 50 records; every 11th line is cut short."""
    rows = views.numbered(spark, sf).withColumn("parsed", F.lit(None).cast("map<string,string>"))
    rows = parse_record(rows, views.MESSAGE_PATTERN, views.UNIT_PATTERN)
    record = F.struct("message", "parsed", "seqno", "priority", "syslog_identifier", "systemd_unit", "realtime_ts", "fields")
    packed = rows.groupBy("client_id", "arrival").agg(ordered_list(F.col("rn"), record).alias("records"))
    envelopes = views.envelopes(spark, sf, rows).join(packed, ["client_id", "arrival"])
    line = F.to_json(
        F.struct("client_id", "reset", "current_position", "next_position", "arrival", "records")
    )
    cut = F.expr("left(line, length(line) - 2)")
    return envelopes.select("arrival", line.alias("line")).select(
        *keep,
        F.when(F.col("arrival") % 11 == 10, cut).otherwise(F.col("line")).alias("value")
    )


@query(
    "scan_batches",
    duckdb_ctes("envelopes")
    + """ SELECT k.client_id, CAST(k.rn // 50 AS BIGINT) AS arrival, CAST(k.rn % 50 AS INTEGER) AS record_index, b.reset,
       b.current_position, b.next_position, k.message, k.seqno, k.priority, k.realtime_ts, k.fields_json ->> 'k' AS field_k,
       CAST(NULL AS INTEGER) AS code, CAST(NULL AS VARCHAR) AS error
FROM v_kept k JOIN v_batches b ON b.client_id = k.client_id AND b.arrival = k.rn // 50 WHERE b.arrival % 11 <> 10
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 400, 'invalid JSON' FROM v_batches WHERE arrival % 11 = 10""",
)
def q_scan_batches(spark, sf):
    path = scratch_path(spark, "batches")
    batch_lines(spark, sf).write.option("compression", "gzip").text(path)
    parsed = scan_batches(spark, path)
    records = batch_records(parsed).withColumn("field_k", F.col("fields")["k"]).drop(
        "fields", "parsed", "syslog_identifier", "systemd_unit"
    )
    return records.unionByName(parsed.filter("code is not null").select("code", "error"), allowMissingColumns=True)


_STORED: dict[tuple[str, str], str] = {}


def stored_log_table(spark, sf) -> str:
    """The records as a stored log table, written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        settings = IngestSettings()
        parsed = parse_record(
            views.records(spark, sf).filter("message <> ''").withColumn("parsed", F.lit(None).cast("map<string,string>")),
            views.MESSAGE_PATTERN,
            views.UNIT_PATTERN,
        )
        path = scratch_path(spark, "logtable")
        to_table_rows(parsed, settings).drop("map_error", "encode_error").write.parquet(path)
        _STORED[key] = path
    return _STORED[key]


def parsed_json(body: str, first: str) -> str:
    """Canonical JSON of a record with its parsed groups, for the fingerprint."""
    parts = ", ".join(
        f"CASE WHEN {sql} <> '' THEN concat('\"{name}\":', CAST(to_json({sql}) AS VARCHAR)) END"
        for name, sql in (
            ("P_DBNAME", f"regexp_extract(systemd_unit, {RE_UNIT}, 1)"),
            ("P_DTTM", f"regexp_extract({first}, {RE}, 1)"),
            ("P_LEVEL", f"regexp_extract({first}, {RE}, 3)"),
            ("P_MESSAGE", body),
            ("P_SERVICE", f"regexp_extract({first}, {RE}, 2)"),
        )
    )
    return f"""concat('{{"fields":{{"k":', CAST(to_json(fields_json ->> 'k') AS VARCHAR), '}},"message":',
       CAST(to_json(message) AS VARCHAR), ',"parsed":{{', concat_ws(',', {parts}), '}},"priority":', CAST(priority AS VARCHAR),
       ',"realtime_ts":', CAST(realtime_ts AS VARCHAR), ',"seqno":', CAST(seqno AS VARCHAR),
       ',"syslog_identifier":', CAST(to_json(syslog_identifier) AS VARCHAR),
       ',"systemd_unit":', CAST(to_json(systemd_unit) AS VARCHAR), '}}')"""


def log_row_sql(source: str, body: str, first: str) -> str:
    matched = f"regexp_matches({first}, {RE})"
    return f"""SELECT realtime_ts AS ts_orig, coalesce(nullif(regexp_extract(systemd_unit, {RE_UNIT}, 1), ''), '-') AS dbname,
       coalesce(nullif(regexp_extract({first}, {RE}, 2), ''), 'unknown') AS service,
       coalesce(nullif(regexp_extract({first}, {RE}, 3), ''), 'unknown') AS level,
       CASE WHEN {matched} THEN coalesce(nullif({body}, ''), message) ELSE message END AS msg, systemd_unit AS unit, seqno,
       realtime_ts AS ts_log, {hash_sql(parsed_json(f"CASE WHEN {matched} THEN {body} ELSE '' END", first))} AS message_hash,
       client_id AS hostname FROM {source}"""


SINGLE_BODY = f"regexp_extract(message, {RE}, 4)"
STORED_LOG = WITH_KEPT + ", log AS (" + log_row_sql("v_kept", SINGLE_BODY, "message") + ")"


@query("scan_log_table", STORED_LOG + " SELECT * FROM log")
def q_scan_log_table(spark, sf):
    return show_rows(scan_log_table(spark, stored_log_table(spark, sf)))


# --- sinks ----------------------------------------------------------------


@query(
    "append_rows",
    "SELECT event_id, event_type FROM events UNION ALL SELECT event_id, event_type FROM events",
)
def q_append_rows(spark, sf):
    path = scratch_path(spark, "append")
    rows = table(spark, sf, "events").select("event_id", "event_type")
    append_rows(rows, path)
    append_rows(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


CELLS = ["doc_id", "lang", "source", "text"]


@query("write_tsv", ROTATED + " SELECT file_idx, line FROM rotated")
def q_write_tsv(spark, sf):
    path = scratch_path(spark, "tsv")
    write_tsv(table(spark, sf, "documents"), path, "docs", ["doc_id"], CELLS, limit=64 * 1024, rotation="global")
    index = F.regexp_extract("_metadata.file_name", "docs_([0-9]+)\\.tsv", 1).cast("bigint")
    return spark.read.text(f"{path}/docs_*.tsv").select(index.alias("file_idx"), F.col("value").alias("line"))


@query(
    "write_tsv_zstd",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source,
       replace(replace(replace(text, chr(9), '\\t'), chr(10), '\\n'), chr(13), '\\r') AS text FROM documents""",
)
def q_write_tsv_zstd(spark, sf):
    path = scratch_path(spark, "zstd")
    write_tsv_zstd(table(spark, sf, "documents"), path, "docs", ["doc_id"], CELLS, limit=256 * 1024)
    return read_tsv_zstd(spark, f"{path}/docs_*.tsv.zst", CELLS)


# --- pipelines ------------------------------------------------------------

SETTINGS = IngestSettings(
    unit_mask="*@db*.service",
    start_pattern=views.START_PATTERN,
    message_pattern=views.MESSAGE_PATTERN,
    unit_pattern=views.UNIT_PATTERN,
    no_match="skip",
    max_messages=3,
    base=1_710_345_600_000,
    mapping=LOG_TABLE_MAPPING,
    columns=LOG_TABLE,
)
FIRST_BODY = f"({BODY})"


@query(
    "ingest_batch",
    MERGED.replace("@max", "3")
    + f""", ok AS (SELECT * REPLACE (1710345600000 + row_number() OVER (PARTITION BY client_id ORDER BY seqno) - 1 AS seqno)
       FROM merged WHERE regexp_matches({FIRST_LINE}, {RE}))
"""
    + log_row_sql("ok", FIRST_BODY, FIRST_LINE),
)
def q_ingest_batch(spark, sf):
    entries = views.records(spark, sf).withColumnRenamed("seqno", "entry_seq").drop("fields_json")
    return show_rows(ingest_batch(entries, SETTINGS))


EXPORT_LIMIT = 64 * 1024
TIME_TEXT = """concat(strftime(make_timestamp({0}), '%Y-%m-%dT%H:%M:%S'),
   CASE WHEN {0} % 1000000 = 0 THEN '' ELSE rtrim(concat('.', lpad(CAST({0} % 1000000 AS VARCHAR), 6, '0')), '0') END, 'Z')"""


def tsv_text(name: str) -> str:
    return f"replace(replace(replace({name}, chr(9), '\\t'), chr(10), '\\n'), chr(13), '\\r')"


EXPORTED = (
    STORED_LOG
    + f""", x AS (SELECT *, concat_ws(chr(9), {TIME_TEXT.format('ts_orig')}, dbname, service, level, {tsv_text('msg')}, unit,
        CAST(seqno AS VARCHAR), {TIME_TEXT.format('ts_log')}, message_hash, hostname) AS line FROM log
  WHERE ts_orig >= epoch_us(TIMESTAMP '2024-01-03 00:00:00') AND ts_orig < epoch_us(TIMESTAMP '2024-01-27 12:00:00')
    AND level IN ('INFO', 'ERROR', 'unknown') AND dbname IN ('db0', 'db2')),
r AS (SELECT line, CAST(strlen(line) + 1 AS BIGINT) AS line_bytes,
        CAST(coalesce(sum(strlen(line) + 1) OVER (ORDER BY ts_orig, ts_log, seqno, hostname, message_hash
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS bytes_before FROM x)
SELECT line, line_bytes, bytes_before // {EXPORT_LIMIT} + 1 AS file_idx, bytes_before FROM r"""
)
TIES = ["ts_log", "seqno", "hostname", "message_hash"]
INTERVAL = ("2024-01-03T00:00:00Z", "2024-01-27T12:00:00Z", ["level=INFO,ERROR", "dbname=db0, db2", "level=unknown"])


@query("export_query", EXPORTED)
def q_export_query(spark, sf):
    log = scan_log_table(spark, stored_log_table(spark, sf))
    return export_query(log, *INTERVAL, ties=TIES, limit=EXPORT_LIMIT)


@query("export_dated", EXPORTED)
def q_export_dated(spark, sf):
    """The same interval from a table by date, loaded in two runs that overlap."""
    log = scan_log_table(spark, stored_log_table(spark, sf))
    path = scratch_path(spark, "by-date")
    early = F.col("ts_orig") < F.lit("2024-01-20").cast("timestamp")
    late = F.col("ts_orig") >= F.lit("2024-01-10").cast("timestamp")
    for part in (log.filter(early).withColumn("level", F.lit("INFO")), log.filter(early), log.filter(late | ~early)):
        upsert_dated(part, path, ["ts_orig", *TIES], "ts_log")
    return export_query(scan_dated(spark, path), *INTERVAL, ties=TIES, limit=EXPORT_LIMIT, date=DATE)


@query(
    "server_batch",
    FOLD
    + f""", good AS (SELECT k.* FROM v_kept k JOIN fold f ON f.client_id = k.client_id AND f.arrival = k.rn // 50 WHERE f.status = 'ok'),
rows_out AS (SELECT hostname, count(*) AS rows_written, max(seqno) AS max_seqno, min(md5_line) AS low_digest, max(md5_line) AS high_digest
  FROM (SELECT *, md5(concat_ws('|', CAST(ts_orig AS VARCHAR), dbname, service, level, msg, unit, CAST(seqno AS VARCHAR), message_hash)) AS md5_line
        FROM ({log_row_sql('good', SINGLE_BODY, 'message')}) l) m GROUP BY 1),
states AS (SELECT client_id, count(*) AS batches, count(*) FILTER (WHERE status = 'ok') AS accepted,
             count(*) FILTER (WHERE status = 'position_mismatch') AS mismatches,
             arg_max(state, arrival) FILTER (WHERE status = 'ok') AS exp_pos FROM fold GROUP BY 1)
SELECT s.client_id, batches, accepted, mismatches, exp_pos, rows_written, max_seqno, low_digest, high_digest
FROM states s JOIN rows_out r ON r.hostname = s.client_id""",
)
def q_server_batch(spark, sf):
    # Batches as they were received: written once, then judged and stored.
    numbered = stage(views.numbered(spark, sf), "received")
    envelopes = views.envelopes(spark, sf, numbered)
    records = numbered.withColumn("record_index", F.expr("rn % 50"))
    # Records arrive with the groups their client extracted.
    records = parse_record(
        records.withColumn("parsed", F.lit(None).cast("map<string,string>")),
        views.MESSAGE_PATTERN,
        views.UNIT_PATTERN,
    )
    served = serve_batches(envelopes, records)
    digest = F.md5(
        F.concat_ws(
            "|", F.unix_micros("ts_orig").cast("string"), "dbname", "service", "level", "msg", "unit",
            F.col("seqno").cast("string"), F.col("message_hash").cast("string"),
        )
    )
    rows = served.rows.withColumn("digest", digest).groupBy(F.col("hostname").alias("client_id")).agg(
        F.count(F.lit(1)).alias("rows_written"),
        F.max("seqno").alias("max_seqno"),
        F.min("digest").alias("low_digest"),
        F.max("digest").alias("high_digest"),
    )
    counts = served.verdicts.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("batches"),
        F.count_if(F.col("status") == "ok").alias("accepted"),
        F.count_if(F.col("status") == "position_mismatch").alias("mismatches"),
    )
    return counts.join(served.positions.select("client_id", "exp_pos"), "client_id").join(rows, "client_id")


