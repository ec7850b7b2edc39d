"""Queries that run streams to the end of their input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.batching import batch_envelopes
from ledgerline.operators.filters import nonempty_message
from ledgerline.operators.mapping import LOG_TABLE_MAPPING
from ledgerline.plans import views
from ledgerline.plans.files import SINGLE_BODY, batch_lines, log_row_sql
from ledgerline.plans.pipelines import IngestSettings
from ledgerline.plans.registry import query
from ledgerline.plans.rows import BATCH_FOLD, MERGED, SPLIT_BYTES, SPLIT_ROWS, WITH_KEPT
from ledgerline.plans.scalars import show_rows
from ledgerline.schema import LOG_TABLE
from ledgerline.session import scratch_path, stage
from ledgerline.sinks.tables import LogTable, PositionTable
from ledgerline.sources.batches import scan_batches
from ledgerline.streaming.ingest import ingest_stream
from ledgerline.streaming.micro import CarriedFolder, Names, fill_batches_stream, merge_lines_stream


DELIVERIES = 4


def _run(spark, df: DataFrame, start: Callable[[DataFrame, str], StreamingQuery], label: str) -> CarriedFolder:
    """Run a stream over the rows of ``df``; its folder.

    Rows come as a client sends them: in deliveries that follow each other in
    stream order, each a trigger (or more) that goes on from what was carried.
    """
    source, path = (scratch_path(spark, f"{label}-{part}") for part in ("in", "stream"))
    df = stage(df, f"{label}-rows")
    cuts = df.approxQuantile("seqno", [k / DELIVERIES for k in range(1, DELIVERIES)], 0.01)
    bounds = [None, *sorted(set(map(int, cuts))), None]
    for low, high in zip(bounds, bounds[1:]):
        part = df if low is None else df.filter(F.col("seqno") >= low)
        part = part if high is None else part.filter(F.col("seqno") < high)
        part.write.mode("append").parquet(source)
        start(spark.readStream.schema(df.schema).parquet(source), path).awaitTermination()
    return CarriedFolder(spark, path)


@query(
    "multiline_stream",
    MERGED.replace("@max", "3")
    + " SELECT client_id, seqno, message, cursor, realtime_ts, priority FROM merged",
)
def q_multiline_stream(spark, sf):
    rows = nonempty_message(views.records(spark, sf)).drop("fields_json")
    done = _run(
        spark, rows, lambda lines, path: merge_lines_stream(lines, path, views.START_PATTERN, max_messages=3, timeout_ms=None), "merged"
    )
    shown = ("client_id", "seqno", "message", "cursor", "realtime_ts", "priority")
    return done.output("entries").select(*shown).unionByName(done.last("held").select(*shown))


@query(
    "batch_stream",
    BATCH_FOLD
    + """ SELECT f.client_id, f.batch_no, arg_min(s.position, s.rn) AS current_position,
       arg_max(s.cursor, s.rn) AS next_position, count(*) AS n_records
FROM fold f JOIN sized s ON s.client_id = f.client_id AND s.rn = f.rn GROUP BY 1, 2""",
)
def q_batch_stream(spark, sf):
    rows = views.kept(spark, sf).drop("fields_json").withColumn("parsed", F.lit(None).cast("map<string,string>"))
    done = _run(
        spark, rows, lambda kept, path: fill_batches_stream(kept, path, SPLIT_ROWS, SPLIT_BYTES, timeout_ms=None), "batched"
    )
    numbers = done.last("counters").select("client_id", F.col("number").alias("batch_no"))
    open_rows = done.last("waiting").join(numbers, "client_id").select(*rows.columns, "batch_no")
    return batch_envelopes(done.output("closed").select(*rows.columns, "batch_no").unionByName(open_rows))


BATCH_OF = 25


@query(
    "discard_on_mismatch",
    WITH_KEPT
    + f""", c AS (SELECT *, CASE WHEN priority = 5 AND CAST(fields_json ->> 'k' AS INTEGER) < 10 THEN 1 ELSE 0 END AS stop FROM v_kept),
e AS (SELECT *, sum(stop) OVER (PARTITION BY client_id ORDER BY seqno ROWS UNBOUNDED PRECEDING) AS epoch FROM c),
n AS (SELECT *, (row_number() OVER (PARTITION BY client_id, epoch ORDER BY seqno) - 1) // {BATCH_OF} AS slot FROM e WHERE stop = 0),
g AS (SELECT client_id, epoch, slot, count(*) AS n_records, arg_min(position, seqno) AS current_position,
             max(cursor) AS next_position FROM n GROUP BY 1, 2, 3 HAVING count(*) = {BATCH_OF})
SELECT client_id, row_number() OVER (PARTITION BY client_id ORDER BY epoch, slot) - 1 AS batch_no,
       n_records, current_position, next_position FROM g""",
)
def q_discard_on_mismatch(spark, sf):
    """Only full batches leave; every mismatch throws the open one away."""
    rows = views.kept(spark, sf).select("client_id", "seqno", "cursor", "position", "message", "priority", "fields_json")
    stop = (F.col("priority") == 5) & (F.get_json_object("fields_json", "$.k").cast("int") < 10)
    size = F.octet_length("message").cast("bigint")
    names = Names(control="control")
    done = _run(
        spark,
        rows.withColumn("control", F.when(stop, "mismatch")),
        lambda rows, path: fill_batches_stream(rows, path, BATCH_OF, 1 << 30, names, timeout_ms=None, size=size),
        "discard",
    )
    return batch_envelopes(done.output("closed"))


INGEST = IngestSettings(mapping=LOG_TABLE_MAPPING, columns=LOG_TABLE)

# Every 11th line is unreadable, so the batch after it does not connect.
STREAM_FOLD = """, b AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY arrival) - 1 AS step
        FROM v_batches WHERE arrival % 11 <> 10),
fold AS (SELECT client_id, arrival, step, CASE WHEN reset THEN 'ok' ELSE 'error' END AS status,
          CASE WHEN reset THEN next_position END AS state FROM b WHERE step = 0
   UNION ALL
   SELECT b.client_id, b.arrival, b.step,
     CASE WHEN b.reset THEN 'ok' WHEN f.state IS NULL THEN 'error' WHEN b.current_position = f.state THEN 'ok' ELSE 'position_mismatch' END,
     CASE WHEN b.reset OR b.current_position = f.state THEN b.next_position ELSE f.state END
   FROM fold f JOIN b ON b.client_id = f.client_id AND b.step = f.step + 1)"""


@query(
    "ingest_stream",
    views.duckdb_ctes("envelopes").replace("WITH ", "WITH RECURSIVE ", 1)
    + STREAM_FOLD
    + """, good AS (SELECT k.* FROM v_kept k JOIN fold f ON f.client_id = k.client_id AND f.arrival = k.rn // 50 WHERE f.status = 'ok')
"""
    + log_row_sql("good", SINGLE_BODY, "message"),
)
def q_ingest_stream(spark, sf):
    lines = batch_lines(spark, sf, keep=["arrival"])
    half = lines.agg(F.max("arrival")).first()[0] // 2
    source = scratch_path(spark, "stream-batches")
    # Two deliveries, one after the other, so the second starts from positions.
    for part in (F.col("arrival") <= half, F.col("arrival") > half):
        lines.filter(part).select("value").write.mode("append").text(source)
        root = source.replace("stream-batches", "stream-store")
        table, positions = LogTable(spark, f"{root}/log"), PositionTable(spark, f"{root}/positions")
        ingest_stream(
            scan_batches(spark, source, streaming=True), table, positions, f"{root}/verdicts", f"{root}/checkpoint", INGEST
        ).awaitTermination()
    return show_rows(table.read())
