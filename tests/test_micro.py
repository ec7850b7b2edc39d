"""Micro-batches with carried frames give the rows of the batch operators."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import batching, sequence, validate
from ledgerline.session import scratch_path, stage
from ledgerline.streaming import micro
from ledgerline.streaming.micro import COUNTERS, CarriedFolder, ClientSettings, Names

LINES = "client_id string, seqno long, message string, cursor string, position string, control string"


def SIZE():
    return F.coalesce(F.length("message"), F.lit(0)).cast("bigint")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def hot_lines(n=300):
    """One client with 90 % of the rows; some rows without a cursor."""
    rng = random.Random(4)
    out = []
    for i in range(n):
        text = ("INFO: " if rng.random() < 0.3 else "") + f"line {i}" + "x" * rng.randint(0, 9)
        out.append(("cold" if i % 10 == 3 else "hot", i, text, f"c{i}" if rng.random() < 0.9 else None, f"c{i - 1}"))
    return out


def triggers(df, count, n=300):
    cuts = [round(k * n / count) for k in range(count + 1)]
    return [df.filter((F.col("seqno") >= a) & (F.col("seqno") < b)) for a, b in zip(cuts, cuts[1:])]


@pytest.mark.parametrize("count", [1, 2, 7])
def test_merge_equals_the_batch_operator(spark, count):
    df = spark.createDataFrame(hot_lines(), "client_id string, seqno long, message string, cursor string, position string")
    want = rows(sequence.multiline_merge(df, "^INFO:", max_messages=4))
    held, got = None, []
    for part in triggers(df, count):
        done, held = micro.merge_step(part, held, "^INFO:", 0, Names(width=16), 4, None)
        held = stage(held, "held")
        got += rows(done)
    assert sorted(got + rows(held.select(df.columns)), key=str) == want
    assert held.count() == 2


@pytest.mark.parametrize("count,limits", [(1, (10, 1 << 20)), (2, (0, 900)), (7, (10, 700))])
def test_batches_equal_the_batch_operator(spark, count, limits):
    df = spark.createDataFrame(hot_lines(), "client_id string, seqno long, message string, cursor string, position string")
    want = rows(batching.batch_split(df, *limits, size=SIZE()))
    waiting, counters, got = None, spark.createDataFrame([], COUNTERS), []
    for part in triggers(df, count):
        closed, waiting, counters = micro.batch_step(
            part, waiting, counters, 0, Names(width=16, batch_width=16), *limits, None, SIZE(), eager=False
        )
        waiting, counters = stage(waiting, "waiting"), stage(counters, "counters")
        got += rows(closed.drop("batch_reset"))
    open_rows = waiting.join(counters.select("client_id", F.col("number").alias("batch_no")), "client_id")
    assert sorted(got + rows(open_rows.select(*df.columns, "batch_no")), key=str) == want


def test_groups_are_client_and_segment(spark):
    df = spark.createDataFrame(hot_lines(50), "client_id string, seqno long, message string, cursor string, position string")
    placed = sequence.place_lines(df.withColumn("_start", F.lit(True)).withColumn("_n", F.lit(1)), "client_id", "seqno", 4, 16, "_n")
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    specs = re.findall(r"windowspecdefinition\((\w+)#\w+, (\w+)#", plan)
    # Lines are in windows of (client, segment); along the client only segments are ordered, one row each.
    assert set(specs) == {("client_id", "_segment")}
    assert "windowspecdefinition(client_id" in plan and not re.search(r"windowspecdefinition\(client_id#\w+, seqno", plan)


def lines(client, *items, begin=0):
    """Items are messages; an item starting with ! is a control row."""
    out = []
    for i, item in enumerate(items, begin):
        control = item[1:] if item.startswith("!") else None
        out.append((client, i, None if control else item, None if control else f"c{i}", f"c{i - 1}", control))
    return out


NAMES = Names(control="control", width=2, batch_width=2)


def merge(spark, *parts, max_messages=1000):
    held, done = None, []
    for part in parts:
        out, held = micro.merge_step(spark.createDataFrame(part, LINES), held, "^INFO:", 0, NAMES, max_messages, None)
        held = stage(held, "held")
        done.append(sorted((r.message, r.cursor) for r in out.collect()))
    return done, sorted((r.message, r.cursor) for r in held.collect())


def test_entry_open_over_triggers(spark):
    done, left = merge(spark, lines("a", "INFO: one", "more"), lines("a", "rest", "INFO: two", begin=2), lines("a", "tail", begin=4))
    assert done == [[], [("INFO: one\nmore\nrest", "c2")], []] and left == [("INFO: two\ntail", "c4")]


def test_controls_on_entries(spark):
    done, left = merge(spark, lines("a", "INFO: one", "INFO: lost", "!mismatch", "back", "INFO: two", "INFO: three"))
    assert sorted(m for m, _ in done[0]) == ["INFO: one", "INFO: two", "back"] and left == [("INFO: three", "c5")]
    # The open entry of an earlier trigger goes too, that of another client stays; a gap keeps it.
    done, left = merge(
        spark, lines("a", "INFO: x", "y") + lines("b", "INFO: z") + lines("g", "INFO: k"),
        lines("a", "!restart", "!mismatch", begin=2) + lines("g", "!gap", "l", begin=2),
    )
    assert done == [[], []] and left == [("INFO: k\nl", "c3"), ("INFO: z", "c0")]


def test_max_lines_over_triggers(spark):
    done, left = merge(spark, lines("a", "INFO: x", "1"), lines("a", "2", "3", "4", begin=2), max_messages=2)
    assert done == [[], [("2\n3", "c3"), ("INFO: x\n1", "c1")]] and left == [("4", "c4")]


def test_controls_on_batches(spark):
    waiting, counters, got = None, spark.createDataFrame([], COUNTERS), []
    for part in (lines("a", "1", "2", "3"), lines("a", "!gap", "4", "5", "!mismatch", "6", "7", "!restart", "8", "9", "10", begin=3)):
        closed, waiting, counters = micro.batch_step(
            spark.createDataFrame(part, LINES), waiting, counters, 0, NAMES, 2, 1 << 20, None, SIZE()
        )
        waiting, counters = stage(waiting, "waiting"), stage(counters, "counters")
        got += [(r.message, r.batch_no, r.batch_reset) for r in closed.orderBy("seqno").collect()]
    assert got == [
        ("1", 0, False), ("2", 0, False), ("3", 1, True), ("4", 1, True), ("6", 2, False), ("7", 2, False),
        ("8", 3, True), ("9", 3, True),
    ]
    assert [r.message for r in waiting.collect()] == ["10"]
    assert [(r.number, r.reset) for r in counters.collect()] == [(4, False)]


def test_timeouts(spark):
    first = spark.createDataFrame(lines("a", "INFO: x") + lines("b", "INFO: y"), LINES)
    _, held = micro.merge_step(first, None, "^INFO:", 1000, NAMES, 9, 500)
    held = stage(held, "held")
    out, held = micro.merge_step(spark.createDataFrame(lines("b", "z", begin=1), LINES), held, "^INFO:", 1600, NAMES, 9, 500)
    assert [r.message for r in out.collect()] == ["INFO: x"] and [r.message for r in held.collect()] == ["INFO: y\nz"]
    none = spark.createDataFrame([], COUNTERS)
    _, waiting, counters = micro.batch_step(first, None, none, 1000, NAMES, 9, 1 << 20, 500, SIZE())
    closed, waiting, _ = micro.batch_step(first.limit(0), stage(waiting, "w"), stage(counters, "c"), 1600, NAMES, 9, 1 << 20, 500, SIZE())
    assert sorted((r.client_id, r.batch_no) for r in closed.collect()) == [("a", 0), ("b", 0)] and waiting.isEmpty()


ENTRIES = (
    "client_id string, entry_seq long, message string, cursor string, systemd_unit string, "
    "parsed map<string,string>, priority int, syslog_identifier string, realtime_ts long, fields map<string,string>"
)


def entries(spark, source, first, *messages):
    data = [("a", i, m, f"c{i}", "u.service", None, 6, "app", 1000 + i, None) for i, m in enumerate(messages, first)]
    spark.createDataFrame(data, ENTRIES).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(ENTRIES).parquet(source)


SETTINGS = ClientSettings(
    start_pattern="^INFO", message_pattern=r"^(?P<P_LEVEL>INFO|WARN) .*$", no_match="skip", base=100, batch_size=2,
    merge_timeout_ms=None, batch_timeout_ms=None, names=Names(order="entry_seq", width=3, batch_width=3),
)


def test_client_stream_survives_a_crash_and_counts_once(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "stream")

    def crash(batch_id):
        raise RuntimeError("power cut")

    micro.client_stream(entries(spark, source, 0, "noise", "INFO one", "more", "INFO two", ""), path, SETTINGS).awaitTermination()
    again = entries(spark, source, 5, "INFO three", "INFO four")
    with pytest.raises(Exception, match="power cut"):
        micro.client_stream(again, path, SETTINGS, between=crash).awaitTermination()
    micro.client_stream(again, path, SETTINGS).awaitTermination()
    micro.client_stream(entries(spark, source, 7, "tail", "INFO five"), path, SETTINGS).awaitTermination()
    folder = CarriedFolder(spark, path)
    got = [(r.seqno, r.position, r.cursor, r.message, r.batch_no) for r in folder.output("closed").orderBy("seqno").collect()]
    # "noise" does not match: it is skipped, and does not advance the position.
    assert got == [
        (100, "", "c2", "INFO one\nmore", 0), (101, "c2", "c3", "INFO two", 0),
        (102, "c3", "c5", "INFO three", 1), (103, "c5", "c7", "INFO four\ntail", 1),
    ]
    assert folder.last("waiting").isEmpty()
    assert [r.message for r in folder.last("held").collect()] == ["INFO five"]


def test_mismatch_comes_back_as_a_restart(spark):
    """From a refused batch to the dropped buffer and the position the client goes on from."""
    source, path = scratch_path(spark, "in"), scratch_path(spark, "stream")
    micro.client_stream(entries(spark, source, 0, *[f"INFO {i}" for i in range(6)]), path, SETTINGS).awaitTermination()
    folder = CarriedFolder(spark, path)
    # The first batch (a reset, as the client was not known) is lost on the way.
    assert {r.batch_no: r.batch_reset for r in folder.output("closed").collect()} == {0: True, 1: False}
    sent = batching.batch_envelopes(folder.output("closed").filter("batch_no > 0")).withColumns(
        {"arrival": F.col("batch_no"), "reset": F.lit(False)}
    )
    stored = spark.createDataFrame([("a", "c7")], "client_id string, exp_pos string")
    judged = stage(validate.position_validate(sent, stored), "judged")
    assert {r.status for r in judged.collect()} == {"position_mismatch"}
    assert folder.last("waiting").count() == 1 and folder.last("held").count() == 1
    for begin in (8, 10):
        micro.client_stream(
            entries(spark, source, begin, f"INFO {begin}", f"INFO {begin + 1}"), path, SETTINGS, verdicts=lambda: judged
        ).awaitTermination()
    # Told once: rows after the verdict are kept, what was buffered before is gone.
    later = folder.output("closed").filter("batch_no > 1").orderBy("seqno").collect()
    assert [(r.position, r.message, r.batch_no, r.batch_reset) for r in later] == [
        ("c7", "INFO 8", 2, False), ("c8", "INFO 9", 2, False)
    ]
    assert sorted(r.message for r in folder.last("waiting").collect()) == ["INFO 10"]
    none = spark.createDataFrame([("a", 9, "position_mismatch", None)], "client_id string, arrival long, status string, expected_position string")
    after, held, waiting = micro.feedback_step(none, folder.last("counters"), folder.last("held"), None, SETTINGS.names)
    assert [(r.exp_pos, r.reset, r.judged) for r in after.collect()] == [("", True, 9)] and held.isEmpty() and waiting is None


def test_ticks_let_idle_entries_go(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "stream")
    spark.createDataFrame(lines("a", "INFO: one", "more"), LINES).coalesce(1).write.parquet(source)
    df = micro.with_ticks(spark.readStream.schema(LINES).parquet(source))
    query = micro.merge_lines_stream(df, path, "^INFO:", Names(), 9, 500, trigger={"processingTime": "200 milliseconds"})
    deadline, got = time.time() + 90, []
    while time.time() < deadline and not got:
        time.sleep(1)
        try:
            got = [r.message for r in CarriedFolder(spark, path).output("entries").collect()]
        except Exception:
            got = []
    query.stop()
    assert got == ["INFO: one\nmore"]
