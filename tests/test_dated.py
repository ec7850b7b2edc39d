"""Tables by date, and loads that keep what fits."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.mapping import FieldMapping
from ledgerline.operators.resume import replay_plan, resume_after
from ledgerline.plans import views
from ledgerline.plans.files import SETTINGS
from ledgerline.plans.pipelines import IngestSettings, export_query, ingest_accepting, ingest_batch
from ledgerline.schema import TableColumn
from ledgerline.sinks.dated import DATE, append_dated, kept_rows, upsert_dated


def rows(spark, values):
    df = spark.createDataFrame(values, "ts string, n long, t string, o int")
    return df.select(F.to_timestamp("ts").alias("ts_orig"), "n", "t", "o")


def stored(spark, path):
    return sorted((str(r.ts_orig), r.n, r.t, str(r[DATE])) for r in spark.read.parquet(path).collect())


def test_upserts_touch_their_dates_only(spark, tmp_path):
    path = str(tmp_path / "log")
    upsert_dated(rows(spark, [("2024-01-01 00:00:00", 1, "a", 1), ("2024-01-01 23:59:59", 2, "b", 1), ("2024-01-02 00:00:00", 1, "c", 1)]), path, ["ts_orig", "n"], "o")
    other = sorted(os.listdir(tmp_path / "log" / f"{DATE}=2024-01-02"))
    again = rows(spark, [("2024-01-01 00:00:00", 1, "old", 1), ("2024-01-01 00:00:00", 1, "new", 2), ("2024-01-03 12:00:00", 5, "d", 1)])
    want = [
        ("2024-01-01 00:00:00", 1, "new", "2024-01-01"), ("2024-01-01 23:59:59", 2, "b", "2024-01-01"),
        ("2024-01-02 00:00:00", 1, "c", "2024-01-02"), ("2024-01-03 12:00:00", 5, "d", "2024-01-03"),
    ]
    for _ in range(2):
        upsert_dated(again, path, ["ts_orig", "n"], "o")
        assert stored(spark, path) == want
    assert sorted(os.listdir(tmp_path / "log" / f"{DATE}=2024-01-02")) == other
    upsert_dated(again.limit(0), path, ["ts_orig", "n"], "o")
    assert stored(spark, path) == want


def test_keys_and_times_are_required(spark, tmp_path):
    path = str(tmp_path / "log")
    with pytest.raises(ValueError, match="one of the keys"):
        upsert_dated(rows(spark, []), path, ["n"], "o")
    with pytest.raises(ValueError, match="no ts_orig"):
        upsert_dated(rows(spark, [(None, 1, "a", 1)]), path, ["ts_orig", "n"], "o")
    assert not os.path.exists(path)


def test_other_dates_are_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    values = [(f"2024-01-{d:02d} 10:00:00", d, "x", 1) for d in range(1, 29)]
    append_dated(rows(spark, values).drop("o"), path)
    log = spark.read.parquet(path)
    lines = export_query(log, "2024-01-03T00:00:00Z", "2024-01-04T00:00:00Z", date=DATE)
    assert [r.line for r in lines.collect()] == ["2024-01-03T10:00:00Z\t3\tx"]
    chosen = log.filter(F.col("n") > 0)
    plan = kept_rows(chosen, rows(spark, values[:1]), [date(2024, 1, 1)], ["ts_orig", "n"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    (filters,) = [l for l in text.splitlines() if "PartitionFilters" in l]
    assert f"({DATE}#" in filters.split("PartitionFilters")[1].split("]")[0]


def test_a_date_with_most_rows_is_many_tasks(spark, tmp_path):
    path = str(tmp_path / "log")
    hot = spark.range(40_000).select(F.timestamp_seconds(F.lit(1_704_067_200)).alias("ts_orig"), F.col("id").alias("n"), F.lit("x").alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        append_dated(hot, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(counts) >= 4 and max(counts) < 20_000


def entries(spark, values):
    return spark.createDataFrame(
        [("c", i, f"k{i}", "u.service", t * 1_000_000, m, i) for i, (t, m) in enumerate(values)],
        "client_id string, entry_seq long, cursor string, systemd_unit string, realtime_ts long, message string, priority int",
    )


PLAIN = dict(
    mapping=[FieldMapping("parsed.N", "n", transform="int64"), FieldMapping("message", "t")],
    columns=[TableColumn("n", "int64"), TableColumn("t", "utf8")],
    message_pattern=r"^n=(?P<N>\S+)",
    keys=["n"],
)


def test_a_record_that_does_not_fit_costs_only_itself(spark):
    given = entries(spark, [(1, "n=1"), (2, "n=99999999999999999999"), (3, "n=3"), (4, "n=3")])
    with pytest.raises(Exception):
        ingest_batch(given, IngestSettings(**PLAIN)).collect()
    target = spark.createDataFrame([(3, "before"), (7, "kept")], "n long, t string")
    out = ingest_accepting(given, IngestSettings(**PLAIN), target)
    assert sorted(map(tuple, out.rows.collect())) == [(1, "n=1"), (3, "n=3"), (7, "kept")]
    (bad,) = out.rejects.collect()
    assert (bad.entry_seq, bad.message, bad.client_id) == (1, "n=99999999999999999999", "c") and bad.error


def test_a_gap_ends_an_entry(spark):
    given = entries(spark, [(1, "n=1"), (2, "more"), (9, "late"), (10, "n=2")])
    settings = dict(PLAIN, start_pattern="^n=", no_match="skip")
    whole = ingest_accepting(given, IngestSettings(**settings)).rows.collect()
    assert sorted(map(tuple, whole)) == [(1, "n=1\nmore\nlate"), (2, "n=2")]
    cut = ingest_accepting(given, IngestSettings(**settings, gap_time="realtime_ts", gap_us=5_000_000)).rows.collect()
    assert sorted(map(tuple, cut)) == [(1, "n=1\nmore"), (2, "n=2")]


def test_both_loads_agree_where_all_fits(spark, sf):
    given = views.records(spark, sf).withColumnRenamed("seqno", "entry_seq").drop("fields_json")
    out = ingest_accepting(given, SETTINGS)
    assert out.rejects.count() == 0
    one = ingest_batch(given, SETTINGS)
    assert sorted(map(str, out.rows.collect())) == sorted(map(str, one.collect()))


@pytest.mark.parametrize("width", [1, 7, 1 << 20])
def test_resumption_and_replay_of_a_hot_client_by_segments(spark, width):
    data = [("hot", i, f"h{i}") for i in range(300)] + [("a", 3, "a3"), ("a", 9, "a9"), ("new", 1, "n1"), ("lost", 5, "l5")]
    given = spark.createDataFrame(data, "client_id string, seqno long, cursor string")
    known = spark.createDataFrame([("hot", "h123"), ("a", "a9"), ("lost", "gone")], "client_id string, exp_pos string")
    out = resume_after(given, known, width=width)
    want = [(c, n, k, False) for c, n, k in data if c == "hot" and n > 123] + [("lost", 5, "l5", True), ("new", 1, "n1", True)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert sorted((r.client_id, r.seqno, r.cursor, r.reset) for r in out.collect()) == sorted(want)
        plan = out._jdf.queryExecution().executedPlan().toString()
        verdicts = spark.createDataFrame(
            [("hot", 4, "position_mismatch", "h99"), ("hot", 5, "position_mismatch", "h1"), ("lost", 1, "position_mismatch", "x"), ("a", 1, "ok", "")],
            "client_id string, arrival long, status string, expected_position string",
        )
        replay = {r.client_id: (r.restart_position, r.reset, r.restart_after, r.replay_rows) for r in replay_plan(verdicts, given, width=width).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert replay == {"hot": ("h99", False, 99, 200), "lost": (None, True, None, 1)}
    # Rows meet anchors by (client, segment): no join or shuffle of rows on the client alone.
    joins = [line for line in plan.splitlines() if "Join [" in line and "LeftOuter" in line]
    assert joins and all("_segment" in line for line in joins)
