"""Sources, TSV files and durable tables."""

import json
import os

import pytest
import zstandard
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerline.operators.export import rotate_files
from ledgerline.operators.filters import in_lists, time_range
from ledgerline.operators.mapping import DEFAULT_MAPPING
from ledgerline.plans import views
from ledgerline.plans.pipelines import IngestSettings, export_query, serve_batches
from ledgerline.schema import TableColumn
from ledgerline.session import scratch_path
from ledgerline.sinks.tables import LogTable, PositionTable
from ledgerline.sinks import tsv
from ledgerline.sinks.tsv import ExportStats, export_prefix, finish_exports, write_tsv, write_tsv_zstd
from ledgerline.sources.batches import scan_batches, split_batches
from ledgerline.sources.journal import read_entries, scan_journal, skip_unreadable, to_records


def read(path):
    with open(path, "rb") as f:
        return f.read()


def test_rotation_and_other_files(spark, tmp_path):
    for name in ("out_000007.tsv", "out_000001.tsv.zst", "out_note.tsv", "other_000001.tsv"):
        (tmp_path / name).write_text("before")
    df = spark.createDataFrame([(1, "aaaa"), (2, "bbbb"), (3, "c\td")], "n int, t string")
    write_tsv(df, str(tmp_path), "out", ["n"], limit=8, partitions=1)
    assert sorted(os.listdir(tmp_path)) == ["other_000001.tsv", "out_000001.tsv", "out_000002.tsv", "out_note.tsv"]
    assert read(tmp_path / "out_000001.tsv") == b"1\taaaa\n2\tbbbb\n"
    assert read(tmp_path / "out_000002.tsv") == b"3\tc\\td\n"


def test_no_file_for_no_rows(spark, tmp_path):
    write_tsv(spark.createDataFrame([], "n int"), str(tmp_path), "out", ["n"])
    assert os.listdir(tmp_path) == []


def test_failed_export_keeps_the_old_one(spark, tmp_path):
    (tmp_path / "out_000001.tsv").write_text("old")
    df = spark.range(3).select("id", F.when(F.col("id") == 2, F.raise_error("broken")).cast("string").alias("t"))
    with pytest.raises(Exception, match="broken"):
        write_tsv(df, str(tmp_path), "out", ["id"])
    assert os.listdir(tmp_path) == ["out_000001.tsv"] and read(tmp_path / "out_000001.tsv") == b"old"


@pytest.mark.parametrize("placed", [0, 1, 3])
def test_an_export_cut_off_while_its_files_get_names_is_completed(spark, tmp_path, monkeypatch, placed):
    for n in (1, 2, 9):
        (tmp_path / f"out_{n:06d}.tsv").write_text("old")
    rows = spark.range(3).select("id", F.lit("abcdef").alias("t"))

    def lost(folder):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(tsv, "_clear", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            write_tsv(rows, str(tmp_path), "out", ["id"], limit=4, partitions=1)
    (manifest,) = [n for n in os.listdir(tmp_path) if n.endswith(".manifest")]
    staged = [json.loads(line) for line in read(tmp_path / manifest).splitlines()]
    # Nothing of the old export is gone yet; now some of the new files get their names.
    assert read(tmp_path / "out_000001.tsv") == b"old"
    for file in staged[:placed]:
        os.replace(file["staged"], tmp_path / file["name"])
    (stats,) = finish_exports(spark, str(tmp_path), "out").values()
    assert stats == ExportStats(3, 3, 9)
    assert sorted(os.listdir(tmp_path)) == [f"out_{n:06d}.tsv" for n in (1, 2, 3)]
    assert [read(tmp_path / f"out_{n:06d}.tsv") for n in (1, 2, 3)] == [b"0\tabcdef\n", b"1\tabcdef\n", b"2\tabcdef\n"]
    assert finish_exports(spark, str(tmp_path), "out") == {}
    assert write_tsv(rows.limit(1), str(tmp_path), "out", ["id"]) == ExportStats(1, 1, 9)
    assert os.listdir(tmp_path) == ["out_000001.tsv"]


def test_export_statistics(spark, tmp_path):
    rows = spark.range(1000).select("id")
    for rotation in ("task", "global"):
        stats = write_tsv(rows, str(tmp_path), "s", ["id"], limit=500, rotation=rotation, partitions=3)
        names = sorted(os.listdir(tmp_path))
        assert stats == ExportStats(1000, len(names), os.path.getsize(tmp_path / names[-1]))
    assert write_tsv(rows.limit(0), str(tmp_path), "none", ["id"]) == ExportStats(0, 0, 0)


@pytest.mark.parametrize("rotation", ["task", "global"])
def test_order_over_many_partitions(spark, tmp_path, rotation):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"), F.repeat(F.lit("x"), 20).alias("t")).repartition(6)
    write_tsv(df, str(tmp_path), "out", ["n"], limit=10_000, rotation=rotation, partitions=4)
    names = sorted(os.listdir(tmp_path))
    text = b"".join(read(tmp_path / n) for n in names)
    assert [int(l.split(b"\t")[0]) for l in text.splitlines()] == list(range(5000))
    sizes = [os.path.getsize(tmp_path / n) for n in names]
    assert max(sizes) < 10_000 + 30
    if rotation == "global":
        assert min(sizes[:-1]) > 10_000 - 30


def test_zstd(spark, tmp_path):
    rows = spark.range(300_000).select("id", F.md5(F.col("id").cast("string")).alias("t"))
    write_tsv_zstd(rows, str(tmp_path), "z", ["id"], limit=1 << 20, partitions=2)
    names = sorted(os.listdir(tmp_path))
    assert len(names) > 2 and all(n.endswith(".tsv.zst") for n in names)
    text = b"".join(zstandard.ZstdDecompressor().decompressobj().decompress(read(tmp_path / n)) for n in names)
    assert [int(l.split(b"\t")[0]) for l in text.splitlines()] == list(range(300_000))


def test_prefix():
    assert export_prefix(" a/b/out ") == "out"
    for bad in ("", ".", "..", "a\\b"):
        with pytest.raises(ValueError):
            export_prefix(bad)


def test_rotate_files_bound(spark):
    df = spark.range(4000).select("id", (F.col("id") % 90 + 10).alias("line_bytes")).repartition(5)
    got = rotate_files(df, ["id"], 5000, partitions=7).orderBy("id").collect()
    total = 0
    for r in got:
        assert (r.bytes_before, r.file_idx) == (total, total // 5000 + 1)
        total += r.line_bytes


def test_export_needs_known_columns(spark):
    log = spark.sql("select timestamp'2025-01-01' ts_orig, 'a' level")
    with pytest.raises(ValueError, match="not found"):
        export_query(log, "2025-01-01T00:00:00Z", "2025-01-02T00:00:00Z", ["host=x"])


def test_filters_reach_the_scan(spark, sf):
    df = views.table(spark, sf, "orders")
    from ledgerline.operators.filters import in_lists, time_range

    out = in_lists(time_range(df, "1995-01-01T00:00:00Z", "1996-01-01T00:00:00Z", "o_orderdate"), ["o_orderstatus=F,O"])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = out.select("o_orderkey")._jdf.queryExecution().explainString(mode)
    pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "In(o_orderstatus" in pushed
    assert "o_totalprice" not in plan[plan.index("ReadSchema") :]


def test_journal(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"MESSAGE":"m","PRIORITY":"3","_HOSTNAME":"h","__CURSOR":"s=1;i=1f;b=2","__REALTIME_TIMESTAMP":"7","X":"y"}\n'
        '{"MESSAGE":"bad"\n\n'
        '{"MESSAGE":"n","PRIORITY":"high","__REALTIME_TIMESTAMP":"x","__HEADER_TIMESTAMP":"9","__SEQNUM":"40"}\n'
    )
    first, second = scan_journal(spark, str(tmp_path)).orderBy("message").collect()
    assert (first.client_id, first.entry_seq, first.priority, first.realtime_ts) == ("h", 31, 3, 7)
    assert first.fields == {"_HOSTNAME": "h", "X": "y"}
    assert (second.entry_seq, second.priority, second.realtime_ts, second.fields) == (40, None, 9, {})
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "a.json").write_text(
        '{"MESSAGE":[27,91,51,49,109,104,105],"PRIORITY":"3","_HOSTNAME":"h","__SEQNUM":"1","__SEQNUM_ID":"q","__MONOTONIC_TIMESTAMP":"5",'
        '"X":["one","two"],"Y":[255,104],"Z":"[1,2]"}\n'
    )
    row = scan_journal(spark, str(tmp_path / "b")).first()
    assert row.message == "\x1b[31mhi"
    assert row.fields == {"_HOSTNAME": "h", "X": "two", "Y": "\ufffdh", "Z": "[1,2]"}
    seen = Observation("seen")
    to_records(skip_unreadable(read_entries(spark.read.text(str(tmp_path))), seen)).collect()
    assert seen.get == {"unreadable": 1, "total": 3}


def test_batches(spark, tmp_path):
    (tmp_path / "b.json").write_text(
        '{"client_id":"a","reset":true,"next_position":"p1","arrival":0,"records":[{"message":"m","seqno":1},{"message":""}]}\n'
        '{"client_id":"a","current_position":"p1","next_position":"p2","arrival":1,"records":[]}\n'
        '{"client_id":"a",\n' + '{"client_id":"' + "x" * 500 + '"}\n'
    )
    parts = split_batches(scan_batches(spark, str(tmp_path), max_bytes=400))
    assert sorted(r.code for r in parts.rejects.collect()) == [400, 413]
    assert [(r.arrival, r.reset, r.n_records) for r in parts.envelopes.orderBy("arrival").collect()] == [(0, True, 2), (1, False, 0)]
    assert [(r.record_index, r.message) for r in parts.records.orderBy("record_index").collect()] == [(0, "m"), (1, "")]


COLUMNS = [TableColumn("k", "int64", False), TableColumn("v", "utf8")]


def kv(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "k long, v string")


def test_log_table(spark, tmp_path):
    table, batch = LogTable(spark, str(tmp_path / "t"), COLUMNS, ["k"]), kv(spark)
    assert table.read().count() == 0
    table.upsert(batch(), 0)
    assert table.read().count() == 0
    table.upsert(batch((1, "a"), (2, "b")), 1)
    table.upsert(batch((2, "c"), (3, "d")), 2)
    table.upsert(batch((2, "c"), (3, "d")), 2)
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "c"), (3, "d")]
    table.upsert(batch((1, "z")), 3)
    again = LogTable(spark, str(tmp_path / "t"), COLUMNS, ["k"])
    assert sorted(map(tuple, again.read().collect())) == [(1, "z"), (2, "c"), (3, "d")]
    assert again.read().columns == ["k", "v"]


def test_a_batch_that_runs_again_replaces_its_own_rows(spark, tmp_path):
    table, batch = LogTable(spark, str(tmp_path / "t"), COLUMNS, ["k"]), kv(spark)
    table.upsert(batch((1, "a"), (2, "b")), 0)
    table.upsert(batch((3, "x"), (4, "x")), 1)
    table.upsert(batch((4, "y")), 1)
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "b"), (4, "y")]
    table.upsert(batch((5, "low"), (5, "high")).withColumn("n", F.length("v")), 2, order="n")
    assert (5, "high") in set(map(tuple, table.read().collect()))


def test_equal_numbers_of_two_streams_lose_nothing(spark, tmp_path):
    """A new checkpoint, or a second stream, numbers its batches from 0 again."""
    table, batch = LogTable(spark, str(tmp_path / "t"), COLUMNS, ["k"]), kv(spark)
    other = LogTable(spark, str(tmp_path / "t"), COLUMNS, ["k"])
    for i in range(5):
        table.upsert(batch((i, f"a{i}")), i, stream="a")
    other.upsert(batch((10, "b0"), (0, "b0")), 0, stream="b")
    table.upsert(batch((11, "c0")), 0, stream="c")
    table.upsert(batch((4, "a4")), 4, stream="a")
    table.upsert(batch((11, "c0")), 0, stream="c")
    want = [(0, "b0"), (1, "a1"), (2, "a2"), (3, "a3"), (4, "a4"), (10, "b0"), (11, "c0")]
    assert sorted(map(tuple, table.read().collect())) == want
    with pytest.raises(ValueError, match="can't name a folder"):
        table.upsert(batch((1, "a")), 0, stream="a/b")


def test_stored_files_hold_apart_ranges_of_the_key(spark, tmp_path):
    table = LogTable(spark, str(tmp_path / "t"), COLUMNS, ["k"])
    table.upsert(spark.range(4000).selectExpr("(id * 7919) % 4000 AS k", "'v' AS v").repartition(8), 0)
    stored = spark.read.parquet(str(tmp_path / "t"))
    by_file = stored.groupBy(F.input_file_name()).agg(F.min("k").alias("low"), F.max("k").alias("high"))
    ranges = sorted((r.low, r.high) for r in by_file.collect())
    assert ranges[0][0] == 0 and ranges[-1][1] == 3999
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_log_table_by_date(spark, tmp_path):
    """A condition on the time reads the interval's dates of all batches, whatever the overwrite mode is."""
    columns = [TableColumn("at", "timestamp", False), TableColumn("v", "utf8")]
    table = LogTable(spark, str(tmp_path / "t"), columns, ["at"])
    rows = lambda *days: spark.createDataFrame([(f"2025-01-{d:02d} 10:00:00", v) for d, v in days], "at string, v string").withColumn(
        "at", F.col("at").cast("timestamp")
    )
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        table.upsert(rows((1, "a"), (2, "b"), (3, "c")), 0, stream="s")
        table.upsert(rows((2, "gone"), (3, "d")), 1, stream="s")
        table.upsert(rows((3, "d")), 1, stream="s")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert sorted(r.v for r in table.read().collect()) == ["a", "b", "d"] and table.read().columns == ["at", "v"]
    day = time_range(table.read(dated=True), "2025-01-02T00:00:00Z", "2025-01-03T00:00:00Z", "at", "log_date")
    assert [r.v for r in day.collect()] == ["b"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "log_date" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_positions_cut_off_while_written_are_not_read(spark, tmp_path):
    table = PositionTable(spark, str(tmp_path / "p"))
    row = lambda p: spark.sql(f"select 'x' client_id, '{p}' exp_pos, current_timestamp() ts_wall, 1L seqno, cast(null as timestamp) ts_orig")
    for i in range(5):
        table.upsert(row(f"p{i}"), i)
    os.remove(tmp_path / "p" / "stream=none" / "batch=4" / "_SUCCESS")
    assert [r.exp_pos for r in table.read().collect()] == ["p3"]
    table.upsert(row("q4"), 4)
    assert [r.exp_pos for r in table.read().collect()] == ["q4"]
    assert sorted(os.listdir(tmp_path / "p" / "stream=none")) == ["batch=2", "batch=3", "batch=4"]
    # Set back to batch 3: what came later runs again.
    table.upsert(row("r3"), 3)
    assert [r.exp_pos for r in table.read().collect()] == ["r3"]


def test_positions_of_two_streams(spark, tmp_path):
    table = PositionTable(spark, str(tmp_path / "p"))
    row = lambda c, p: spark.sql(f"select '{c}' client_id, '{p}' exp_pos, current_timestamp() ts_wall, 1L seqno, cast(null as timestamp) ts_orig")
    for i in range(5):
        table.upsert(row("x", f"a{i}"), i, stream="a")
    table.upsert(row("y", "b0"), 0, stream="b")
    assert {r.client_id: r.exp_pos for r in table.read().collect()} == {"x": "a4", "y": "b0"}
    # Batch 4 of stream a runs again, after stream b has moved on.
    assert {r.client_id: r.exp_pos for r in table.read(before=4, stream="a").collect()} == {"x": "a3", "y": "b0"}
    table.upsert(row("x", "a5"), 4, stream="a")
    table.upsert(row("x", "c0"), 0, stream="c")
    assert {r.client_id: r.exp_pos for r in table.read().collect()} == {"x": "c0", "y": "b0"}
    assert {r.client_id: r.exp_pos for r in table.read(before=0, stream="c").collect()} == {"x": "a5", "y": "b0"}


def test_arrivals_missing_or_repeated_are_refused(spark, tmp_path):
    line = '{"client_id":"a","reset":true,"next_position":"p%s"%s,"records":[{"message":"m%s"}]}\n'
    (tmp_path / "b.json").write_text(
        line % (1, "", 1) + line % (2, ',"arrival":0', 2) + line % (3, ',"arrival":0', 3) + line % (4, ',"arrival":1', 4)
    )
    parts = split_batches(scan_batches(spark, str(tmp_path)))
    assert sorted((r.code, r.error) for r in parts.rejects.collect()) == [
        (400, "arrival is repeated"), (400, "arrival is repeated"), (400, "arrival is required"),
    ]
    assert [r.arrival for r in parts.envelopes.collect()] == [1] and [r.message for r in parts.records.collect()] == ["m4"]


def test_built_in_mapping_through_the_server_path(spark, tmp_path):
    columns = [TableColumn(m.destination, "utf8") for m in DEFAULT_MAPPING if not m.transform] + [
        TableColumn("log_timestamp_us", "timestamp"), TableColumn("message_hash", "uint64"),
    ]
    mapping = [m for m in DEFAULT_MAPPING if m.destination in {c.name for c in columns}]
    settings = IngestSettings(mapping=mapping, columns=columns, keys=["message_hash"])
    (tmp_path / "b.json").write_text(
        '{"client_id":"a","reset":true,"next_position":"p1","arrival":0,"records":[{"message":"m","seqno":7,"realtime_ts":5},{"message":"n","seqno":9,"realtime_ts":4}]}\n'
    )
    parts = split_batches(scan_batches(spark, str(tmp_path)))
    served = serve_batches(parts.envelopes, parts.records, None, settings)
    assert sorted((r.client_id, r.message) for r in served.rows.collect()) == [("a", "m"), ("a", "n")]
    assert [(r.exp_pos, r.seqno) for r in served.positions.collect()] == [("p1", 9)]


def test_typed_lists(spark):
    df = spark.sql("select 5 i, 1.5d d, true b, timestamp'2025-01-01 00:00:00' t, date'2025-01-02' day, cast(2.50 as decimal(5,2)) m")
    for spec in ("i=5,6", "d=1.5", "b=TRUE", "t=2025-01-01T00:00:00Z,2025-01-01T03:00:00+03:00", "day=2025-01-02", "m=2.5"):
        assert in_lists(df, [spec]).count() == 1, spec
    for spec in ("i=6", "i=99999999999", "m=2.501", "t=2025-01-01T00:00:01Z"):
        assert in_lists(df, [spec]).count() == 0, spec
    for spec in ("i=x", "t=2025-01-01 00:00:00", "b=yes"):
        with pytest.raises(ValueError, match="is no"):
            in_lists(df, [spec])


def test_position_table(spark, tmp_path):
    table = PositionTable(spark, str(tmp_path / "p"))
    assert table.read() is None
    row = lambda p: spark.sql(f"select 'a' client_id, '{p}' exp_pos, current_timestamp() ts_wall, 1L seqno, cast(null as timestamp) ts_orig")
    table.upsert(row("p1"), 0)
    table.upsert(row("p2"), 1)
    table.upsert(row("p3"), 1)
    assert table.read().first().exp_pos == "p3"
    assert table.read(before=1).first().exp_pos == "p1"


@pytest.fixture
def on_a_cluster(spark):
    """A new path in the shared folder, while the session says that it runs on a cluster."""
    path, before = scratch_path(spark, "exports"), spark.conf.get("spark.master")
    spark.conf.set("spark.master", "spark://elsewhere:7077")
    yield path.removeprefix("file://")
    spark.conf.set("spark.master", before)


@pytest.mark.parametrize("write,ending", [(write_tsv, "tsv"), (write_tsv_zstd, "tsv.zst")])
def test_a_cluster_exports_to_its_shared_folder(spark, on_a_cluster, tmp_path, write, ending):
    for path in (f"file://{on_a_cluster}/out", f"{on_a_cluster}/out"):
        assert write(spark.range(3), path, "out", ["id"], partitions=1).rows_written == 3
        assert os.listdir(f"{on_a_cluster}/out") == [f"out_000001.{ending}"]
    with pytest.raises(ValueError, match="local folder"):
        write(spark.range(3), str(tmp_path), "out", ["id"])


@pytest.mark.parametrize("write,ending", [(write_tsv, "tsv"), (write_tsv_zstd, "tsv.zst")])
def test_export_through_a_mount(spark, tmp_path, write, ending):
    mount = ending.replace(".", "-")
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{mount}.link./in", f"file://{tmp_path}")
    assert write(spark.range(3), f"viewfs://{mount}/in/new/out", "out", ["id"], partitions=1).rows_written == 3
    assert os.listdir(tmp_path / "new" / "out") == [f"out_000001.{ending}"]
