"""Field mapping, schema checks and conformance."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.mapping import DEFAULT_MAPPING, FieldMapping, check_mapping, conform_schema, map_fields
from ledgerline.operators.merge import upsert_positions, upsert_rows
from ledgerline.operators.resume import lookup_positions, resume_after
from ledgerline.schema import RECORD, TableColumn


def record(spark, **values):
    base = {"message": "hello", "parsed": None, "seqno": 1, "priority": 6, "syslog_identifier": "", "systemd_unit": "",
            "realtime_ts": 5, "fields": None}
    row = {**base, **values}
    return spark.createDataFrame([tuple(row[n] for n in RECORD.names)], RECORD).withColumn("client_id", F.lit("host-01"))


def test_defaults_and_missing(spark):
    mapping = [
        FieldMapping("parsed.MISSING", "with_default", default="fallback"),
        FieldMapping("parsed.ALSO", "without_default"),
        FieldMapping("message", "msg"),
    ]
    row = map_fields(record(spark), mapping).first()
    assert (row.with_default, row.without_default, row.msg, row.map_error) == ("fallback", None, "hello", None)


def test_client_only_where_mapped(spark):
    assert map_fields(record(spark), [FieldMapping("client_id", "hostname")]).first().hostname == "host-01"
    assert "client_id" not in map_fields(record(spark), [FieldMapping("message", "msg")]).columns


def test_later_entry_wins_only_with_a_value(spark):
    mapping = [FieldMapping("message", "msg"), FieldMapping("parsed.P_MESSAGE", "msg")]
    assert map_fields(record(spark), mapping).first().msg == "hello"
    assert map_fields(record(spark, parsed={"P_MESSAGE": "body"}), mapping).first().msg == "body"
    # A present but empty map value is a value.
    assert map_fields(record(spark, parsed={"P_MESSAGE": ""}), mapping).first().msg == ""


def test_default_mapping(spark):
    row = map_fields(record(spark, parsed={"P_DTTM": "2025-03-13T10:00:00"})).first()
    assert row.log_dttm.hour == 10 and row.client_id == "host-01" and row.priority == 6
    assert len(DEFAULT_MAPPING) == 11


def test_bad_value_is_an_error(spark):
    row = map_fields(record(spark, fields={"n": "x"}), [FieldMapping("fields.n", "n", transform="int")]).first()
    assert row.n is None and row.map_error.startswith("map fields.n -> n")


def test_log_timestamp_falls_back_to_now(spark):
    mapping = [FieldMapping("log_timestamp_us", "ts", transform="timestamp64_us")]
    assert map_fields(record(spark, realtime_ts=None), mapping).first().ts.year >= 2024


COLUMNS = [
    TableColumn("log_dttm", "timestamp64"), TableColumn("priority", "int32"), TableColumn("message", "utf8"), TableColumn("flag", "bool"),
]


def test_schema_check():
    check_mapping([FieldMapping("parsed.P_DTTM", "log_dttm"), FieldMapping("priority", "priority", transform="int")], COLUMNS)
    for entry, reason in (
        (FieldMapping("message", "missing_col"), "not found"),
        (FieldMapping("message", " "), "empty destination"),
        (FieldMapping("priority", "log_dttm", transform="bool"), "incompatible"),
        (FieldMapping("parsed.P_DTTM", "priority", transform="timestamp64"), "incompatible"),
        (FieldMapping("message", "flag", transform="uint64"), "incompatible"),
        (FieldMapping("message", "message", transform="uuid"), "unsupported"),
    ):
        with pytest.raises(ValueError, match=reason):
            check_mapping([entry], COLUMNS)
    with pytest.raises(ValueError, match="missing required column"):
        check_mapping([], [TableColumn("hostname", "utf8", nullable=False)], require_all=True)


def test_encode_error_for_out_of_range(spark):
    columns = [TableColumn("n", "int8")]
    row = map_fields(record(spark, seqno=300), [FieldMapping("seqno", "n", transform="int64")], columns).first()
    assert row.n is None and "n" in row.encode_error and row.map_error is None


def test_conform(spark):
    columns = [TableColumn("msg", "utf8"), TableColumn("hostname", "utf8", nullable=False)]
    row = conform_schema(spark.sql("select 'h' hostname, 1 extra"), columns).first()
    assert tuple(row) == (None, "h", None)
    row = conform_schema(spark.sql("select 'm' msg"), columns).first()
    assert row.encode_error == 'missing required column "hostname"'


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, "old"), (2, "kept")], "k int, v string")
    incoming = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (3, "c", 1)], "k int, v string, n int")
    once = upsert_rows(target, incoming, ["k"], "n")
    twice = upsert_rows(once, incoming, ["k"], "n")
    want = [(1, "b"), (2, "kept"), (3, "c")]
    assert sorted(map(tuple, once.collect())) == want == sorted(map(tuple, twice.collect()))


def test_positions_keep_numbers_when_absent(spark):
    stored = spark.sql("select 'a' client_id, 'p1' exp_pos, timestamp'2025-01-01' ts_wall, 5L seqno, timestamp'2025-01-01' ts_orig")
    incoming = spark.sql("select 'a' client_id, 'p2' exp_pos, timestamp'2025-01-02' ts_wall, cast(null as bigint) seqno, cast(null as timestamp) ts_orig")
    row = upsert_positions(stored, incoming).first()
    assert (row.exp_pos, row.ts_wall.day, row.seqno, row.ts_orig.day) == ("p2", 2, 5, 1)


def test_resume_needs_the_exact_cursor(spark):
    rows = spark.createDataFrame([("a", i, f"c{i}") for i in range(4)], "client_id string, seqno long, cursor string")
    at = lambda p: resume_after(rows, spark.createDataFrame([("a", p)], "client_id string, exp_pos string"))
    assert [(r.seqno, r.reset) for r in at("c1").orderBy("seqno").collect()] == [(2, False), (3, False)]
    assert at("c1x").filter("reset").count() == 4


def test_lookup(spark):
    clients = spark.createDataFrame([("a",), ("b",), ("",)], "client_id string")
    positions = spark.createDataFrame([("a", "p9")], "client_id string, exp_pos string")
    got = {r.client_id: (r.status, r.current_position) for r in lookup_positions(clients, positions).collect()}
    assert got == {"a": ("ok", "p9"), "b": ("not_found", None), "": ("error", None)}
