"""Ordered operators give the same rows however streams are cut into segments."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import batching, sequence, stats, validate
from ledgerline.operators.streams import previous_in_stream
from ledgerline.plans import views

WIDTHS = [7, 64]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def lines(spark, sf):
    return views.records(spark, sf).filter("message <> ''").drop("fields", "fields_json").cache()


@pytest.mark.parametrize("width", WIDTHS)
def test_multiline_merge(lines, width):
    want = sequence.multiline_merge(lines, views.START_PATTERN, max_messages=3)
    got = sequence.multiline_merge(lines, views.START_PATTERN, max_messages=3, width=width)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("width", WIDTHS)
def test_merge_of_a_stream_that_never_starts(spark, width):
    data = [("a", i, f"line {i}", f"c{i}") for i in range(50)]
    df = spark.createDataFrame(data, "client_id string, seqno long, message string, cursor string")
    got = rows(sequence.multiline_merge(df, "^START", max_messages=20, width=width))
    want = [
        ("a", a, "\n".join(f"line {i}" for i in range(a, b)), f"c{b - 1}") for a, b in ((0, 20), (20, 40), (40, 50))
    ]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("width", WIDTHS)
def test_merge_timeout(lines, width):
    args = {"time": "realtime_ts", "timeout_us": 600_000_000}
    want = rows(sequence.multiline_merge(lines, views.START_PATTERN, **args))
    assert rows(sequence.multiline_merge(lines, views.START_PATTERN, width=width, **args)) == want
    assert len(want) > sequence.multiline_merge(lines, views.START_PATTERN).count()


@pytest.mark.parametrize("width", WIDTHS)
def test_positions_and_numbers(lines, width):
    real = lines.withColumn("cursor", F.when(F.col("seqno") % 5 != 0, F.col("cursor")))
    want = sequence.ack_positions(real, "p0")
    assert rows(sequence.ack_positions(real, "p0", width=width).select(want.columns)) == rows(want)
    numbered = sequence.assign_seqno(lines, 100, to="n")
    assert rows(sequence.assign_seqno(lines, 100, to="n", width=width)) == rows(numbered)


@pytest.mark.parametrize("width", WIDTHS)
def test_previous_row(lines, width):
    only = F.col("priority") == 3
    want = previous_in_stream(lines, {"before": "cursor"}, only=only)
    assert rows(previous_in_stream(lines, {"before": "cursor"}, only=only, width=width)) == rows(want)


@pytest.mark.parametrize("width", WIDTHS)
def test_gap_markers(lines, width):
    want = sequence.gap_markers(lines, "lost", gap_us=3_000_000_000)
    assert rows(sequence.gap_markers(lines, "lost", gap_us=3_000_000_000, width=width)) == rows(want)
    assert want.count() > 0


def test_inserted_markers(spark):
    data = [("a", 1, 1_000_000, "c1"), ("a", 2, 2_000_000, "c2"), ("a", 3, 90_000_000, "c3")]
    df = spark.createDataFrame(data, "client_id string, seqno long, realtime_ts long, cursor string")
    marks = sequence.gap_markers(df, "lost", gap_us=5_000_000)
    out = sequence.insert_markers(df, marks).orderBy("after_order", "synthetic").collect()
    assert [r.cursor for r in out] == ["c1", "c2", None, "c3"]
    mark = out[2]
    assert (mark.message, mark.priority, mark.position) == ("1970-01-01T00:00:02.001Z :LEDGERLINE ALERT: lost", 2, "c2")
    assert (mark.realtime_ts, mark.seqno) == (2_001_000, 2_001)
    positioned = sequence.ack_positions(df.unionByName(marks.select(df.columns)), "p0").orderBy("seqno").collect()
    assert positioned[-1].cursor is None and positioned[-1].position == "c3"


def fold_batches(rows, max_rows, max_bytes):
    """Next-fit, one row at a time: (order, size, next_size, open_size, real)."""
    out, number, used, real, count = {}, 0, 0, 0, 0
    for order, size, nxt, opening, is_real in rows:
        if count and ((real and used + size + 1 + nxt > max_bytes) or (is_real and real >= max_rows > 0)):
            number, used, real, count = number + 1, 0, 0, 0
        if not count:
            used = opening
        used, real, count = used + size + 1, real + is_real, count + 1
        out[order] = number
    return out


@pytest.mark.parametrize("width", [*WIDTHS, 1 << 20])
@pytest.mark.parametrize("limits", [(10, 1 << 30), (0, 900), (4, 700)])
def test_batch_split(spark, width, limits):
    rng = random.Random(width)
    data = []
    for client in ("a", "b", "c"):
        position = "p"
        for i in range(150):
            cursor = f"c{i}" if rng.random() < 0.8 else None
            data.append((client, i, position, cursor, rng.randint(10, 90)))
            position = cursor or position
    df = spark.createDataFrame(data, "client_id string, seqno long, position string, cursor string, size long")
    got = batching.batch_split(df, *limits, size=F.col("size"), width=width)
    got = {(r.client_id, r.seqno): r.batch_no for r in got.collect()}
    for client in ("a", "b", "c"):
        sized = [
            (o, s, len(c or p) + 2, 13 + 14 + 17 + 11 + 1 + 3 + 20 + len(p) + 2 + 1, int(c is not None))
            for cl, o, p, c, s in data if cl == client
        ]
        want = fold_batches(sized, *limits)
        assert {o: got[client, o] for o in want} == want


def hot_batches(spark, n=1200):
    """One client with 90 % of the rows, in segments of a few rows."""
    rng = random.Random(5)
    data = [("hot" if i % 10 else "cold", i, f"c{i - 1}", f"c{i}" if rng.random() < 0.9 else None, rng.randint(10, 90)) for i in range(n)]
    return spark.createDataFrame(data, "client_id string, seqno long, position string, cursor string, size long")


@pytest.mark.parametrize("limits", [(40, 1 << 30), (0, 2500)])
def test_folded_cuts_bound_a_task(spark, limits, monkeypatch):
    df = hot_batches(spark)
    want = rows(batching.batch_split(df, *limits, size=F.col("size"), fan=1 << 20))
    seen = spark.sparkContext.accumulator(0)
    joined = batching.fold_cuts

    def watched(tables, *args):
        whole = joined(tables, *args)
        # 400 segments of three rows: a folded map stays one batch's worth, its inputs FAN of those.
        assert len(tables) <= 4 and len(whole) <= 60
        seen.add(1)
        return whole

    monkeypatch.setattr(batching, "fold_cuts", watched)
    assert rows(batching.batch_split(df, *limits, size=F.col("size"), width=3, fan=4)) == want
    assert seen.value > 100


def test_open_batches_go_on(spark):
    df = hot_batches(spark, 400)
    whole = {(r.client_id, r.seqno): r.batch_no for r in batching.batch_split(df, 30, 1500, size=F.col("size")).collect()}
    cut = 217
    states, sizes = [], {r.seqno: r for r in df.collect()}
    for client in ("hot", "cold"):
        number = max(n for (c, s), n in whole.items() if c == client and s < cut)
        open_rows = [sizes[s] for (c, s), n in sorted(whole.items()) if c == client and s < cut and n == number]
        opening = 13 + 14 + 17 + 11 + 1 + len(client) + 2 + 20 + len(open_rows[0].position) + 2
        used = opening + sum(r["size"] + 1 for r in open_rows)
        states.append((client, used, sum(r.cursor is not None for r in open_rows), number))
    start = spark.createDataFrame(states, f"client string, {batching.STATE}")
    rest = batching.batch_split(df.filter(F.col("seqno") >= cut), 30, 1500, size=F.col("size"), width=16, start=start)
    got = {(r.client_id, r.seqno): r.batch_no for r in rest.collect()}
    assert got == {k: n for k, n in whole.items() if k[1] >= cut}


def test_folded_positions(spark):
    rng, names = random.Random(9), [f"p{i}" for i in range(5)]
    batches = [(i, rng.random() < 0.02, rng.choice(names), rng.choice(names), None) for i in range(300)]
    df = spark.createDataFrame(
        [("a", *b) for b in batches],
        "client_id string, arrival long, reset boolean, current_position string, next_position string, record_error string",
    )
    want = {a: s for a, s, _ in judge(batches, "p0")}
    stored = spark.createDataFrame([("a", "p0")], "client_id string, exp_pos string")
    got = validate.position_validate(df, stored, width=2, fan=4).collect()
    assert {r.arrival: r.status for r in got} == want


def test_folded_map_is_the_maps_in_turn():
    rng, names = random.Random(1), ["a", "b", "c", "d"]
    for _ in range(200):
        tables = []
        for _ in range(rng.randint(1, 5)):
            pairs = {rng.choice(names): rng.choice(names) for _ in range(rng.randint(0, 3))}
            if rng.random() < 0.3:
                pairs[None] = rng.choice(names)
            pairs = list(pairs.items()) or [(None, None)]
            tables.append(pd.DataFrame(pairs, columns=["state_in", "state_out"], dtype=object))
        whole = validate.fold_effects(tables)
        for state in [None, *((n,) for n in names)]:
            now = state
            for table in tables:
                now = validate._pass(now, table)
            assert validate._pass(state, whole) == now


def test_oversized_record_fails(spark):
    df = spark.createDataFrame([("a", 1, "p", "c", 500)], "client_id string, seqno long, position string, cursor string, size long")
    with pytest.raises(Exception, match="exceeds maximum batch request size"):
        batching.batch_split(df, 10, 100, size=F.col("size")).collect()


def test_rows_without_cursor_are_not_a_batch(spark):
    schema = "client_id string, seqno long, position string, cursor string, size long"
    alone = spark.createDataFrame([("a", 1, "p1", None, 5)], schema)
    split = batching.batch_split(alone, 1, 1 << 20, size=F.col("size"))
    assert batching.batch_envelopes(split).count() == 0
    joined = spark.createDataFrame([("a", 1, "p1", None, 5), ("a", 2, "p1", "p2", 5)], schema)
    split = batching.batch_split(joined, 1, 1 << 20, size=F.col("size"))
    row = batching.batch_envelopes(split).first()
    assert (row.current_position, row.next_position, row.n_records) == ("p1", "p2", 2)


def judge(batches, stored):
    state, out = stored, []
    for arrival, reset, current, after, wrong in batches:
        if not after:
            out.append((arrival, "error", validate.NO_NEXT))
        elif not reset and not current:
            out.append((arrival, "error", validate.NO_CURRENT))
        elif not reset and state is None:
            out.append((arrival, "error", validate.NO_STORED))
        elif not reset and current != state:
            out.append((arrival, "position_mismatch", state))
        elif wrong:
            out.append((arrival, "error", wrong))
        else:
            state = after
            out.append((arrival, "ok", after))
    return out


@pytest.mark.parametrize("width", [3, 11, 1 << 18])
@pytest.mark.parametrize("resets", [0.0, 0.1])
def test_position_validate(spark, width, resets):
    rng = random.Random(width)
    data, want = [], {}
    stored = {"a": "p0", "b": None, "c": "p1"}
    for client in stored:
        batches, names = [], [f"p{i}" for i in range(6)] + [""]
        for i in range(80):
            wrong = "invalid records[0]: x" if rng.random() < 0.1 else None
            batches.append((i, rng.random() < resets, rng.choice(names), rng.choice(names), wrong))
        data += [(client, *b) for b in batches]
        want.update({(client, a): (s, t) for a, s, t in judge(batches, stored[client])})
    df = spark.createDataFrame(
        data, "client_id string, arrival long, reset boolean, current_position string, next_position string, record_error string"
    )
    positions = spark.createDataFrame([(c, p) for c, p in stored.items() if p], "client_id string, exp_pos string")
    got = validate.position_validate(df, positions, width=width).collect()
    assert len(got) == len(data)
    for r in got:
        detail = {"ok": r.next_position, "position_mismatch": r.expected_position, "error": r.message}[r.status]
        assert (r.status, detail) == want[r.client_id, r.arrival]
        assert r.code == {"ok": 200, "position_mismatch": 409, "error": 400}[r.status]


def test_missing_client_id(spark):
    df = spark.createDataFrame(
        [("", 0, True, "", "p1")],
        "client_id string, arrival long, reset boolean, current_position string, next_position string",
    )
    assert validate.position_validate(df).first().message == "client_id is required"


@pytest.mark.parametrize("width", [3])
def test_continuity_gaps(spark, sf, width):
    envelopes = views.envelopes(spark, sf).drop("n_records")
    assert rows(stats.continuity_gaps(envelopes, width)) == rows(stats.continuity_gaps(envelopes))


@pytest.mark.parametrize("width,fan", [(3, 2), (16, 4), (1 << 20, 16)])
@pytest.mark.parametrize("limits", [(6, 1 << 30), (0, 500), (4, 450)])
def test_epochs_cut_inside_a_stream(spark, width, fan, limits, monkeypatch):
    """As if each epoch were a client of its own, but a group is a client's segment."""
    rng, data, epoch = random.Random(width), [], {"a": 0, "b": 7}
    for i in range(260):
        client = "b" if i % 10 == 3 else "a"
        epoch[client] += rng.choice((1, 3)) if rng.random() < (0.02 if 80 < i < 180 else 0.3) else 0
        data.append((client, i, f"c{i - 1}", f"c{i}" if rng.random() < 0.8 else None, rng.randint(10, 90), epoch[client]))
    df = spark.createDataFrame(data, "client_id string, seqno long, position string, cursor string, size long, epoch long")
    own = df.withColumn("client_id", F.concat("client_id", F.lpad(F.col("epoch").cast("string"), 3, "0")))
    # Sizes count the client's name, so names of the same length make the same cuts.
    df = df.withColumn("client_id", F.concat("client_id", F.lit("000")))
    want = {r.seqno: r.batch_no for r in batching.batch_split(own, *limits, size=F.col("size")).collect()}
    groups, starts = spark.sparkContext.accumulator(0), batching._starts

    def counted(*args):
        run = starts(*args)

        def one(key: tuple, rows: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
            groups.add(1)
            return run(key, rows, states)

        return one

    monkeypatch.setattr(batching, "_starts", counted)
    split = batching.batch_split(df, *limits, size=F.col("size"), width=width, fan=fan, epoch="epoch")
    assert {r.seqno: r.batch_no for r in split.collect()} == want
    assert groups.value == len({(r[0], r[1] // width) for r in data})
