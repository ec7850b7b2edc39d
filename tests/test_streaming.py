"""Streams: restart between the two writes, timers, control rows."""

import time

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.batching import batch_envelopes
from ledgerline.schema import LOG_TABLE
from ledgerline.session import scratch_path
from ledgerline.sinks.tables import LogTable, PositionTable
from ledgerline.sources.batches import scan_batches
from ledgerline.streaming.ingest import ingest_stream
from ledgerline.streaming.stateful import batch_stream, drain_batches, drain_entries, multiline_stream

LINES = "client_id string, seqno long, message string, cursor string, position string, control string"


def batch(client, arrival, current, after, messages, reset=False):
    records = ",".join(f'{{"message":"{m}","seqno":{arrival * 10 + i},"realtime_ts":{1000 + i}}}' for i, m in enumerate(messages))
    return (
        f'{{"client_id":"{client}","reset":{str(reset).lower()},"current_position":"{current}",'
        f'"next_position":"{after}","arrival":{arrival},"records":[{records}]}}\n'
    )


def test_failure_between_writes(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(
        batch("h1", 0, "", "p1", ["a", "b"], reset=True) + batch("h1", 1, "p1", "p2", ["c"]) + batch("h1", 2, "bad", "p3", ["d"])
        + batch("h2", 0, "p0", "p1", ["e"])
    )
    table, positions = LogTable(spark, str(tmp_path / "log")), PositionTable(spark, str(tmp_path / "pos"))

    def run(between=None):
        query = ingest_stream(
            scan_batches(spark, str(source), streaming=True), table, positions,
            str(tmp_path / "out"), str(tmp_path / "check"), between=between,
        )
        query.awaitTermination()

    def crash(batch_id):
        raise RuntimeError("power cut")

    with pytest.raises(Exception, match="power cut"):
        run(crash)
    assert positions.read() is None
    run()
    assert sorted(r.msg for r in table.read().collect()) == ["a", "b", "c"]
    assert [(r.client_id, r.exp_pos, r.seqno) for r in positions.read().collect()] == [("h1", "p2", 10)]
    verdicts = spark.read.parquet(str(tmp_path / "out" / "verdicts"))
    assert {(r.client_id, r.arrival, r.code) for r in verdicts.collect()} == {
        ("h1", 0, 200), ("h1", 1, 200), ("h1", 2, 409), ("h2", 0, 400),
    }
    # A later delivery starts from the stored position; an empty batch advances it.
    (source / "b.json").write_text(batch("h1", 3, "p2", "p3", []) + batch("h1", 4, "p3", "p4", ["f", ""]) + batch("h1", 5, "p3", "p4", ["g"]))
    run()
    assert sorted(r.msg for r in table.read().collect()) == ["a", "b", "c", "g"]
    assert positions.read().first().exp_pos == "p4"
    assert len(table.read().columns) == len(LOG_TABLE)


def stream_of(spark, *frames):
    path = scratch_path(spark, "test-lines")
    for rows in frames:
        spark.createDataFrame(rows, LINES).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(LINES).option("maxFilesPerTrigger", "1").parquet(path)


def run(spark, out, seconds=None):
    sink, check = scratch_path(spark, "test-out"), scratch_path(spark, "test-check")
    writer = out.writeStream.format("parquet").option("checkpointLocation", check)
    if seconds is None:
        writer.trigger(availableNow=True).start(sink).awaitTermination()
    else:
        query = writer.trigger(processingTime="500 milliseconds").start(sink)
        deadline = time.time() + seconds
        while time.time() < deadline and not _count(spark, out, sink):
            time.sleep(1)
        query.stop()
    return spark.read.schema(out.schema).parquet(sink), check


def _count(spark, out, sink):
    try:
        return spark.read.schema(out.schema).parquet(sink).count()
    except Exception:
        return 0


def lines(client, *items, begin=0):
    """Items are messages; an item starting with ! is a control row."""
    out = []
    for i, item in enumerate(items, begin):
        control = item[1:] if item.startswith("!") else None
        out.append((client, i, None if control else item, None if control else f"c{i}", f"c{i - 1}", control))
    return out


def test_entry_open_over_triggers_and_drained(spark):
    df = stream_of(spark, lines("a", "INFO: one", "more"), lines("a", "rest", "INFO: two", begin=2), lines("a", "tail", begin=4))
    merged, check = run(spark, multiline_stream(df, "^INFO:", timeout_ms=None, control="control"))
    assert [(r.message, r.cursor) for r in merged.collect()] == [("INFO: one\nmore\nrest", "c2")]
    left = drain_entries(spark, check, merged).collect()
    assert [(r.message, r.cursor) for r in left] == [("INFO: two\ntail", "c4")]


def test_mismatch_discards_the_open_entry(spark):
    df = stream_of(spark, lines("a", "INFO: one", "INFO: lost", "!mismatch", "back", "INFO: two", "INFO: three"))
    merged, _ = run(spark, multiline_stream(df, "^INFO:", timeout_ms=None, control="control"))
    assert sorted(r.message for r in merged.collect()) == ["INFO: one", "INFO: two", "back"]


def test_max_lines_over_triggers(spark):
    df = stream_of(spark, lines("a", "INFO: x", "1"), lines("a", "2", "3", "4", begin=2))
    merged, check = run(spark, multiline_stream(df, "^INFO:", max_messages=2, timeout_ms=None, control="control"))
    assert sorted(r.message for r in merged.collect()) == ["2\n3", "INFO: x\n1"]
    assert [r.message for r in drain_entries(spark, check, merged).collect()] == ["4"]


def test_idle_entry_leaves_by_timer(spark):
    df = stream_of(spark, lines("a", "INFO: one", "more"))
    merged, _ = run(spark, multiline_stream(df, "^INFO:", timeout_ms=1000, control="control"), seconds=60)
    assert [r.message for r in merged.collect()] == ["INFO: one\nmore"]


def test_old_batch_leaves_by_timer(spark):
    df = stream_of(spark, lines("a", "x", "y"))
    out = batch_stream(df, 10, 1 << 20, timeout_ms=1000, size=F.coalesce(F.length("message"), F.lit(0)).cast("bigint"), control="control")
    got, _ = run(spark, out, seconds=60)
    assert [(r.message, r.batch_no) for r in got.orderBy("seqno").collect()] == [("x", 0), ("y", 0)]


def test_controls_on_batches(spark):
    df = stream_of(
        spark, lines("a", "1", "2", "3"), lines("a", "!gap", "4", "5", "!mismatch", "6", "7", "!restart", "8", "9", "10", begin=3)
    )
    size = F.coalesce(F.length("message"), F.lit(0)).cast("bigint")
    got, check = run(spark, batch_stream(df, 2, 1 << 20, timeout_ms=None, size=size, control="control"))
    rows = [(r.message, r.batch_no, r.batch_reset) for r in got.orderBy("seqno").collect()]
    assert rows == [
        ("1", 0, False), ("2", 0, False), ("3", 1, True), ("4", 1, True), ("6", 2, False), ("7", 2, False),
        ("8", 3, True), ("9", 3, True),
    ]
    like = got.drop("batch_no", "batch_reset")
    assert [r.message for r in drain_batches(spark, check, like).collect()] == ["10"]
    assert batch_envelopes(got).count() == 4
