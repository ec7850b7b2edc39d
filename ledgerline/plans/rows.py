"""Queries for filters, ordered operators, counts, joins and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.parse import parse_record
from ledgerline.operators import resume, stats
from ledgerline.operators.batching import batch_envelopes, batch_split
from ledgerline.operators.export import order_by_time, render_rows, rotate_files
from ledgerline.operators.filters import in_lists, nonempty_message, time_range, unit_filter
from ledgerline.operators.merge import latest_position, upsert_positions, upsert_rows
from ledgerline.operators.sequence import assign_seqno, gap_markers, multiline_merge
from ledgerline.operators.validate import first_record_errors, position_validate, validate_records
from ledgerline.plans import views
from ledgerline.plans.registry import query
from ledgerline.plans.scalars import RE, RE_UNIT, _parsed
from ledgerline.plans.views import duckdb_ctes, table

WITH_RECORDS = duckdb_ctes("records")
WITH_KEPT = duckdb_ctes("kept")
WITH_BATCHES = duckdb_ctes("envelopes")


# --- filters --------------------------------------------------------------


@query(
    "unit_filter",
    WITH_RECORDS
    + r""" SELECT seqno, systemd_unit FROM v_records
WHERE regexp_matches(systemd_unit, '^[^p].*@db[0-9]\.service$') AND regexp_matches(systemd_unit, '[a-z]@db[01]')
""",
)
def q_unit_filter(spark, sf):
    df = views.records(spark, sf).select("seqno", "systemd_unit")
    for mask in ("", " [^p]*@db?.service ", "regex:[a-z]@db[01]"):
        df = unit_filter(df, mask)
    return df


@query("nonempty_message", WITH_RECORDS + " SELECT client_id, seqno, cursor FROM v_records WHERE message <> ''")
def q_nonempty(spark, sf):
    return nonempty_message(views.records(spark, sf)).select("client_id", "seqno", "cursor")




def _batched_records(spark, sf):
    """All records in batches of 50, empty messages included."""
    rows = assign_seqno(views.records(spark, sf), 0, to="rn")
    return rows.withColumns({"arrival": F.expr("rn div 50"), "record_index": F.expr("rn % 50").cast("int")})


@query(
    "validate_records",
    WITH_RECORDS
    + """, b AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY seqno) - 1 AS rn FROM v_records),
g AS (SELECT client_id, CAST(rn // 50 AS BIGINT) AS arrival, count(*) AS n_records,
             min(CASE WHEN message = '' THEN rn % 50 END) AS bad FROM b GROUP BY 1, 2)
SELECT client_id, arrival, n_records,
       CASE WHEN bad IS NOT NULL THEN concat('invalid records[', CAST(bad AS VARCHAR), ']: record must include message') END AS record_error,
       CASE WHEN bad IS NULL THEN n_records ELSE 0 END AS kept_records FROM g""",
)
def q_validate_records(spark, sf):
    rows = _batched_records(spark, sf)
    by = ["client_id", "arrival"]
    counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_records"))
    kept = validate_records(rows, by).groupBy(*by).agg(F.count(F.lit(1)).alias("kept_records"))
    return (
        counts.join(first_record_errors(rows, by), by, "left")
        .join(kept, by, "left")
        .withColumn("kept_records", F.coalesce("kept_records", F.lit(0)))
    )


MERGED = (
    WITH_RECORDS
    + rf""", f AS (SELECT *, CASE WHEN regexp_matches(message, '{views.START_PATTERN}')
              OR row_number() OVER (PARTITION BY client_id ORDER BY seqno) = 1 THEN 1 ELSE 0 END AS starts
       FROM v_records WHERE message <> ''),
i AS (SELECT *, sum(starts) OVER (PARTITION BY client_id ORDER BY seqno ROWS UNBOUNDED PRECEDING) AS island FROM f),
p AS (SELECT *, (row_number() OVER (PARTITION BY client_id, island ORDER BY seqno) - 1) // @max AS part FROM i),
merged AS (SELECT client_id, min(seqno) AS seqno, string_agg(message, chr(10) ORDER BY seqno) AS message,
             max(cursor) AS cursor, arg_min(realtime_ts, seqno) AS realtime_ts, arg_min(priority, seqno) AS priority,
             arg_min(syslog_identifier, seqno) AS syslog_identifier, arg_min(systemd_unit, seqno) AS systemd_unit,
             arg_min(fields_json, seqno) AS fields_json
      FROM p GROUP BY client_id, island, part)"""
)
FIRST_LINE = "split_part(message, chr(10), 1)"
REST = "CASE WHEN strpos(message, chr(10)) > 0 THEN substr(message, strpos(message, chr(10)) + 1) END"
BODY = f"concat(regexp_extract({FIRST_LINE}, {RE}, 4), coalesce(chr(10) || {REST}, ''))"


@query(
    "multiline_merge",
    MERGED.replace("@max", "2")
    + " SELECT client_id, seqno, message, cursor, realtime_ts, priority FROM merged",
)
def q_multiline_merge(spark, sf):
    rows = nonempty_message(views.records(spark, sf)).drop("fields")
    merged = multiline_merge(rows, views.START_PATTERN, max_messages=2)
    return merged.select("client_id", "seqno", "message", "cursor", "realtime_ts", "priority")


@query(
    "parse_skip",
    MERGED.replace("@max", "1000")
    + f""" SELECT client_id, seqno, regexp_extract({FIRST_LINE}, {RE}, 3) AS p_level, {BODY} AS p_message,
       regexp_extract(systemd_unit, {RE_UNIT}, 1) AS p_dbname
FROM merged WHERE regexp_matches({FIRST_LINE}, {RE})""",
)
def q_parse_skip(spark, sf):
    rows = nonempty_message(views.records(spark, sf)).drop("fields")
    merged = multiline_merge(rows, views.START_PATTERN)
    parsed = parse_record(merged, views.MESSAGE_PATTERN, views.UNIT_PATTERN, "skip")
    return parsed.select("client_id", "seqno", *_parsed("P_LEVEL", "P_MESSAGE", "P_DBNAME"))


@query(
    "time_range",
    """SELECT o_orderkey, epoch_us(o_orderdate) AS at FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-03-01 00:00:00' AND o_orderdate < TIMESTAMP '1996-09-30 21:00:00'""",
)
def q_time_range(spark, sf):
    rows = time_range(
        table(spark, sf, "orders"), "1995-03-01T00:00:00Z", "1996-10-01T00:00:00+03:00", "o_orderdate"
    )
    return rows.select("o_orderkey", F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("at"))


@query(
    "in_lists",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '3-MEDIUM', '5-LOW')""",
)
def q_in_lists(spark, sf):
    rows = in_lists(
        table(spark, sf, "orders"),
        ["o_orderstatus=F", "o_orderpriority= 1-URGENT,,3-MEDIUM", "o_orderstatus=O, F", "o_orderpriority=5-LOW"],
    )
    return rows.select("o_orderkey", "o_orderstatus", "o_orderpriority")


# --- ordered operators ----------------------------------------------------


@query("ack_positions", WITH_KEPT + " SELECT client_id, seqno, cursor, position FROM v_kept")
def q_ack_positions(spark, sf):
    return views.kept(spark, sf).select("client_id", "seqno", "cursor", "position")


@query(
    "assign_seqno",
    WITH_KEPT + " SELECT client_id, cursor, 1710345600000 + rn AS seqno FROM v_kept",
)
def q_assign_seqno(spark, sf):
    rows = nonempty_message(views.records(spark, sf)).withColumnRenamed("seqno", "entry_seq")
    return assign_seqno(rows, 1_710_345_600_000, order="entry_seq").select("client_id", "cursor", "seqno")


# Limits that both cut: some batches fill up by count, others by bytes.
SPLIT_ROWS, SPLIT_BYTES = 40, 9_400

RECORD_SIZE = """strlen(concat('{"message":', CAST(to_json(message) AS VARCHAR), ',"seqno":', CAST(seqno AS VARCHAR),
  ',"priority":', CAST(priority AS VARCHAR),
  CASE WHEN syslog_identifier = '' THEN '' ELSE concat(',"syslog_identifier":"', syslog_identifier, '"') END,
  ',"systemd_unit":"', systemd_unit, '","realtime_ts":', CAST(realtime_ts AS VARCHAR),
  ',"fields":{"k":"', fields_json ->> 'k', '"}}'))"""

BATCH_FOLD = (
    WITH_KEPT.replace("WITH ", "WITH RECURSIVE ", 1)
    + f""", sized AS MATERIALIZED (SELECT client_id, rn, cursor, position, {RECORD_SIZE} AS size,
    strlen(cursor) + 2 AS next_size, 56 + strlen(client_id) + 2 + 20 + strlen(position) + 2 + 1 AS open_size FROM v_kept),
fold AS (SELECT client_id, rn, CAST(0 AS BIGINT) AS batch_no, CAST(1 AS BIGINT) AS n, open_size + size + 1 AS used
         FROM sized WHERE rn = 0
   UNION ALL
   SELECT s.client_id, s.rn,
          CASE WHEN f.n >= {SPLIT_ROWS} OR f.used + s.size + 1 + s.next_size > {SPLIT_BYTES} THEN f.batch_no + 1 ELSE f.batch_no END,
          CASE WHEN f.n >= {SPLIT_ROWS} OR f.used + s.size + 1 + s.next_size > {SPLIT_BYTES} THEN 1 ELSE f.n + 1 END,
          CASE WHEN f.n >= {SPLIT_ROWS} OR f.used + s.size + 1 + s.next_size > {SPLIT_BYTES}
               THEN s.open_size + s.size + 1 ELSE f.used + s.size + 1 END
   FROM fold f JOIN sized s ON s.client_id = f.client_id AND s.rn = f.rn + 1)"""
)


@query(
    "batch_split",
    BATCH_FOLD
    + """ SELECT f.client_id, f.batch_no, arg_min(s.position, s.rn) AS current_position,
       arg_max(s.cursor, s.rn) AS next_position, count(*) AS n_records
FROM fold f JOIN sized s ON s.client_id = f.client_id AND s.rn = f.rn GROUP BY 1, 2""",
)
def q_batch_split(spark, sf):
    rows = views.kept(spark, sf).withColumn("parsed", F.lit(None).cast("map<string,string>"))
    return batch_envelopes(batch_split(rows, SPLIT_ROWS, SPLIT_BYTES))


ROTATE_LIMIT = 64 * 1024
DOCUMENT_LINE = (
    "concat(CAST(doc_id AS VARCHAR), chr(9), lang, chr(9), source, chr(9), "
    "replace(replace(replace(text, chr(9), '\\t'), chr(10), '\\n'), chr(13), '\\r'))"
)
ROTATED = f"""WITH d AS (SELECT doc_id, {DOCUMENT_LINE} AS line FROM documents),
s AS (SELECT doc_id, line, CAST(strlen(line) + 1 AS BIGINT) AS line_bytes FROM d),
r AS (SELECT doc_id, line, line_bytes,
        CAST(coalesce(sum(line_bytes) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS bytes_before FROM s),
rotated AS (SELECT *, bytes_before // {ROTATE_LIMIT} + 1 AS file_idx FROM r)"""


def _rotated(spark, sf):
    cells = ["doc_id", "lang", "source", "text"]
    docs = table(spark, sf, "documents").select(*cells)
    return rotate_files(
        docs, ["doc_id"], ROTATE_LIMIT, prepare=lambda rows: render_rows(rows, cells, ["doc_id"])
    )


@query("rotate_files", ROTATED + " SELECT doc_id, line_bytes, bytes_before, file_idx, md5(line) AS digest FROM rotated")
def q_rotate_files(spark, sf):
    return _rotated(spark, sf).withColumn("digest", F.md5("line")).drop("line")


@query(
    "export_stats",
    ROTATED
    + """ SELECT count(*) AS rows_written, count(DISTINCT file_idx) AS files_written,
       CAST((SELECT sum(line_bytes) FROM rotated WHERE file_idx = (SELECT max(file_idx) FROM rotated)) AS BIGINT) AS bytes_last_file
FROM rotated""",
)
def q_export_stats(spark, sf):
    return stats.export_stats(_rotated(spark, sf))


GAP_US = 45 * 60 * 1_000_000
MARK_TEXT = "log stream was interrupted"


@query(
    "gap_markers",
    WITH_KEPT
    + f""", g AS (SELECT client_id, realtime_ts - lag(realtime_ts) OVER w AS gap, lag(cursor) OVER w AS good_cursor,
        lag(seqno) OVER w AS after_order, lag(realtime_ts) OVER w + 1000 AS mark_us FROM v_kept
        WINDOW w AS (PARTITION BY client_id ORDER BY seqno)),
m AS (SELECT *, md5(good_cursor) AS h, make_timestamp(mark_us) AS t FROM g WHERE gap > {GAP_US})
SELECT client_id, mark_us // 1000 AS seqno, mark_us AS realtime_ts, 2 AS priority, 'LEDGERLINE' AS systemd_unit,
       concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-4', substr(h, 14, 3), '-',
              ['8', '9', 'a', 'b'][CAST(concat('0x', substr(h, 17, 1)) AS INTEGER) % 4 + 1], substr(h, 18, 3), '-', substr(h, 21, 12)) AS syslog_identifier,
       concat(strftime(t, '%Y-%m-%dT%H:%M:%S'),
         CASE WHEN mark_us % 1000000 = 0 THEN '' ELSE rtrim(concat('.', lpad(CAST(mark_us % 1000000 AS VARCHAR), 6, '0')), '0') END,
         'Z :LEDGERLINE ALERT: {MARK_TEXT}') AS message,
       good_cursor AS position, CAST(NULL AS VARCHAR) AS cursor, after_order FROM m""",
)
def q_gap_markers(spark, sf):
    rows = views.kept(spark, sf).drop("fields", "fields_json")
    return gap_markers(rows, MARK_TEXT, gap_us=GAP_US)


# --- counts ---------------------------------------------------------------

FOLD = (
    WITH_BATCHES.replace("WITH ", "WITH RECURSIVE ", 1)
    + """, b AS MATERIALIZED (SELECT * FROM v_batches),
fold AS (SELECT client_id, arrival, CASE WHEN reset THEN 'ok' ELSE 'error' END AS status,
          CASE WHEN reset THEN next_position END AS state, CAST(NULL AS VARCHAR) AS expected, n_records,
          CASE WHEN NOT reset THEN 'missing current_position or reset required' END AS message FROM b WHERE arrival = 0
   UNION ALL
   SELECT b.client_id, b.arrival,
     CASE WHEN b.reset THEN 'ok' WHEN f.state IS NULL THEN 'error' WHEN b.current_position = f.state THEN 'ok' ELSE 'position_mismatch' END,
     CASE WHEN b.reset OR b.current_position = f.state THEN b.next_position ELSE f.state END,
     CASE WHEN NOT b.reset AND b.current_position <> f.state THEN f.state END, b.n_records,
     CASE WHEN NOT b.reset AND f.state IS NULL THEN 'missing current_position or reset required' END
   FROM fold f JOIN b ON b.client_id = f.client_id AND b.arrival = f.arrival + 1)"""
)
VERDICT_SQL = """SELECT f.client_id, f.arrival, f.status,
       CASE f.status WHEN 'ok' THEN 200 WHEN 'position_mismatch' THEN 409 ELSE 400 END AS code,
       CASE WHEN f.status = 'ok' THEN f.state END AS next_position, f.expected AS expected_position, f.message
FROM fold f"""


@query("position_validate", FOLD + " " + VERDICT_SQL)
def q_position_validate(spark, sf):
    return position_validate(views.envelopes(spark, sf))


@query(
    "position_update",
    WITH_KEPT
    + """ SELECT client_id, CAST(rn // 50 AS BIGINT) AS arrival, max(seqno) AS seqno, max(realtime_ts) AS ts_orig
FROM v_kept GROUP BY 1, 2""",
)
def q_position_update(spark, sf):
    out = views.updates(views.numbered(spark, sf)).drop("ts_wall")
    return out.withColumn("ts_orig", F.unix_micros("ts_orig"))


@query(
    "batch_stats",
    WITH_KEPT
    + """ SELECT client_id, CAST(rn // 50 AS BIGINT) AS arrival, count(*) AS n_records,
       CAST(sum(strlen(message)) AS BIGINT) AS message_bytes FROM v_kept GROUP BY 1, 2""",
)
def q_batch_stats(spark, sf):
    return stats.batch_stats(views.numbered(spark, sf), ["client_id", "arrival"])


@query(
    "verdict_counts",
    FOLD
    + """ SELECT client_id, count(*) AS batches, CAST(sum(n_records) AS BIGINT) AS records,
       count(*) FILTER (WHERE status = 'position_mismatch') AS mismatches,
       count(*) FILTER (WHERE status = 'error') AS errors FROM fold GROUP BY 1""",
)
def q_verdict_counts(spark, sf):
    envelopes = views.envelopes(spark, sf)
    verdicts = position_validate(envelopes)
    counted = verdicts.join(envelopes.select("client_id", "arrival", "n_records"), ["client_id", "arrival"])
    return stats.verdict_counts(counted)


@query(
    "continuity_gaps",
    WITH_BATCHES
    + """, l AS (SELECT client_id, arrival, reset, current_position,
        lag(next_position) OVER (PARTITION BY client_id ORDER BY arrival) AS previous_next FROM v_batches)
SELECT client_id, arrival, current_position, previous_next FROM l
WHERE NOT reset AND previous_next IS NOT NULL AND current_position <> previous_next""",
)
def q_continuity_gaps(spark, sf):
    gaps = stats.continuity_gaps(views.envelopes(spark, sf))
    return gaps.select("client_id", "arrival", "current_position", "previous_next")


# --- joins ----------------------------------------------------------------


@query(
    "lookup_positions",
    WITH_KEPT
    + """, pos AS (SELECT client_id, max(cursor) AS exp_pos FROM v_kept GROUP BY 1),
clients AS (SELECT DISTINCT CASE WHEN user_id % 6 = 5 THEN '' ELSE concat('host-', CAST(user_id % 6 AS VARCHAR)) END AS client_id FROM events)
SELECT c.client_id, CASE WHEN c.client_id = '' THEN 'error' WHEN p.client_id IS NULL THEN 'not_found' ELSE 'ok' END AS status,
       p.exp_pos AS current_position, CASE WHEN c.client_id = '' THEN 'client_id is required' END AS message
FROM clients c LEFT JOIN pos p ON p.client_id = c.client_id""",
)
def q_lookup_positions(spark, sf):
    positions = nonempty_message(views.records(spark, sf)).groupBy("client_id").agg(F.max("cursor").alias("exp_pos"))
    slot = F.col("user_id") % 6
    clients = (
        table(spark, sf, "events")
        .select(F.when(slot == 5, "").otherwise(F.concat(F.lit("host-"), slot.cast("string"))).alias("client_id"))
        .distinct()
    )
    return resume.lookup_positions(clients, positions)


STORED = """, pos AS (SELECT client_id, CASE WHEN client_id = 'host-1' THEN concat(max(cursor), 'x') ELSE max(cursor) END AS exp_pos
        FROM v_kept WHERE client_id <> 'host-2' AND priority = 3 GROUP BY 1)"""


def _stored(rows):
    """Positions in the data, one that is not (host-1), and one missing (host-2)."""
    last = rows.filter((F.col("client_id") != "host-2") & (F.col("priority") == 3))
    last = last.groupBy("client_id").agg(F.max("cursor").alias("exp_pos"))
    return last.withColumn(
        "exp_pos",
        F.when(F.col("client_id") == "host-1", F.concat("exp_pos", F.lit("x"))).otherwise(F.col("exp_pos")),
    )


@query(
    "resume_after",
    WITH_KEPT
    + STORED
    + """, a AS (SELECT k.client_id, k.seqno AS anchor FROM v_kept k JOIN pos p ON p.client_id = k.client_id AND p.exp_pos = k.cursor)
SELECT k.client_id, k.seqno, k.cursor, a.anchor IS NULL AS reset FROM v_kept k LEFT JOIN a ON a.client_id = k.client_id
WHERE a.anchor IS NULL OR k.seqno > a.anchor""",
)
def q_resume_after(spark, sf):
    rows = nonempty_message(views.records(spark, sf)).select("client_id", "seqno", "cursor", "priority")
    return resume.resume_after(rows, _stored(rows)).drop("priority")


@query(
    "replay_plan",
    FOLD
    + """, v AS (SELECT client_id, min(arrival) AS rejected_arrival, arg_min(expected, arrival) AS expected_position
        FROM fold WHERE status = 'position_mismatch' GROUP BY 1),
p AS (SELECT v.*, k.seqno AS restart_after FROM v LEFT JOIN v_kept k ON k.client_id = v.client_id AND k.cursor = v.expected_position)
SELECT p.client_id, rejected_arrival, expected_position, CASE WHEN restart_after IS NOT NULL THEN expected_position END AS restart_position,
       restart_after IS NULL AS reset, restart_after,
       (SELECT count(*) FROM v_kept k WHERE k.client_id = p.client_id AND (p.restart_after IS NULL OR k.seqno > p.restart_after)) AS replay_rows
FROM p""",
)
def q_replay_plan(spark, sf):
    rows = nonempty_message(views.records(spark, sf)).select("client_id", "seqno", "cursor")
    return resume.replay_plan(position_validate(views.envelopes(spark, sf)), rows)


# --- order and upserts ----------------------------------------------------


@query("order_by_time", "SELECT event_id, epoch_us(ts) AS at, event_type FROM events ORDER BY ts, event_id")
def q_order_by_time(spark, sf):
    rows = order_by_time(table(spark, sf, "events"), "ts", ["event_id"])
    return rows.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_type")


@query(
    "latest_position",
    WITH_BATCHES
    + " SELECT client_id, arg_max(next_position, arrival) AS exp_pos, arg_max(max_seqno, arrival) AS seqno FROM v_batches GROUP BY 1",
)
def q_latest_position(spark, sf):
    versions = views.envelopes(spark, sf).select(
        "client_id",
        F.col("next_position").alias("exp_pos"),
        F.col("max_seqno").alias("seqno"),
        F.col("arrival").alias("version"),
    )
    return latest_position(versions)


@query(
    "upsert_rows",
    """WITH i AS (SELECT l_orderkey AS o_orderkey, l_linestatus AS o_orderstatus, l_extendedprice AS o_totalprice,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_extendedprice DESC, l_linestatus DESC) AS rn FROM lineitem)
SELECT o_orderkey, o_orderstatus, o_totalprice FROM i WHERE rn = 1
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def q_upsert_rows(spark, sf):
    target = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    incoming = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_linenumber").alias("line"),
    )
    ordered = incoming.withColumns({"_price": F.col("o_totalprice"), "_status": F.col("o_orderstatus")})
    return upsert_rows(target, ordered, ["o_orderkey"], ["line", "_price", "_status"])


@query(
    "upsert_positions",
    WITH_BATCHES
    + """, s AS (SELECT client_id, arg_min(next_position, arrival) AS exp_pos, min(max_seqno) AS seqno, min(max_realtime_ts) AS ts
        FROM v_batches WHERE client_id <> 'host-3' GROUP BY 1),
i AS (SELECT client_id, arg_max(next_position, arrival) AS exp_pos, CASE WHEN client_id <> 'host-1' THEN max(max_seqno) END AS seqno,
             CASE WHEN client_id <> 'host-2' THEN max(max_realtime_ts) END AS ts, max(max_realtime_ts) AS wall
      FROM v_batches WHERE client_id <> 'host-0' GROUP BY 1)
SELECT coalesce(i.client_id, s.client_id) AS client_id, coalesce(i.exp_pos, s.exp_pos) AS exp_pos,
       CASE WHEN i.client_id IS NULL THEN s.ts ELSE i.wall END AS ts_wall,
       coalesce(i.seqno, s.seqno) AS seqno, coalesce(i.ts, s.ts) AS ts_orig
FROM s FULL OUTER JOIN i ON i.client_id = s.client_id""",
)
def q_upsert_positions(spark, sf):
    batches = views.envelopes(spark, sf)
    stored = (
        batches.filter(F.col("client_id") != "host-3")
        .groupBy("client_id")
        .agg(
            F.min_by("next_position", "arrival").alias("exp_pos"),
            F.timestamp_micros(F.min("max_realtime_ts")).alias("ts_wall"),
            F.min("max_seqno").alias("seqno"),
            F.timestamp_micros(F.min("max_realtime_ts")).alias("ts_orig"),
        )
    )
    name = F.col("client_id")
    incoming = (
        batches.filter(name != "host-0")
        .groupBy("client_id")
        .agg(
            F.max_by("next_position", "arrival").alias("exp_pos"),
            F.timestamp_micros(F.max("max_realtime_ts")).alias("ts_wall"),
            F.max("max_seqno").alias("seqno"),
            F.timestamp_micros(F.max("max_realtime_ts")).alias("ts_orig"),
        )
        .withColumns(
            {"seqno": F.when(name != "host-1", F.col("seqno")), "ts_orig": F.when(name != "host-2", F.col("ts_orig"))}
        )
    )
    out = upsert_positions(stored, incoming)
    return out.withColumns({"ts_wall": F.unix_micros("ts_wall"), "ts_orig": F.unix_micros("ts_orig")})


