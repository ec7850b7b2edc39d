"""Text, number and time rules, stated as cases."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import coerce, fields, parse, text, transforms
from ledgerline.functions.regex import PatternError, compile_pattern, glob_to_java
from ledgerline.operators.filters import parse_instant, parse_lists, time_range, unit_filter
from ledgerline.plans.views import MESSAGE_PATTERN, UNIT_PATTERN


def evaluate(spark, cases, build, schema="x string"):
    """``build`` gives the columns for ``x``; one result tuple per case, in order."""
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], f"i int, {schema}")
    return [tuple(r)[1:] for r in df.select("i", *build(F.col("x"))).orderBy("i").collect()]


WRONG = "wrong"
T0 = datetime(2025, 3, 13, 10, 0, 0)
CASES = [
    ("", "abc", "abc"), ("string", "", ""), ("int", "42", 42), ("int", "+7", 7), ("int", " 5", WRONG),
    ("int", "x", WRONG), ("int64", "9223372036854775807", 2**63 - 1), ("int64", "9223372036854775808", WRONG),
    ("int64", "1.5", WRONG), ("uint64", "18446744073709551615", 2**64 - 1), ("uint64", "18446744073709551616", WRONG),
    ("uint64", "-1", WRONG), ("uint64", "0" * 50 + "12", 12), ("float64", "3.5", 3.5), ("float64", "nan-ish", WRONG),
    ("float64", "1e400", WRONG), ("float64", "-Inf", float("-inf")), ("float64", "infinity", float("inf")),
    ("float64", "0x1p-2", 0.25), ("float64", "1d", WRONG), ("float64", ".5", 0.5), ("float64", "5.", 5.0),
    ("float64", ".", WRONG), ("bool", "true", True), ("bool", "0", False), ("bool", "maybe", WRONG), ("bool", "tRuE", WRONG),
    ("rfc3339", "2025-03-13T10:00:00Z", T0), ("rfc3339", "2025-03-13T12:30:00+02:30", T0),
    ("rfc3339", "13/03/2025", WRONG), ("rfc3339", "2025-03-13T10:00:00", WRONG), ("rfc3339", "2025-02-30T10:00:00Z", WRONG),
    ("timestamp64_us", "1741860000000000", T0), ("timestamp64_us", " 1741860000000000 ", T0), ("timestamp64_us", "abc", WRONG),
    ("timestamp64", "1741860000000000", T0), ("timestamp64", "2025-03-13T10:00:00.123456789Z", T0.replace(microsecond=123456)),
    ("timestamp64", "2025-03-13 10:00:00+00:00", T0), ("timestamp64", "2025-03-13 10:00:00.123456Z", T0.replace(microsecond=123456)),
    ("timestamp64", "2025-03-13T10:00:00", T0), ("timestamp64", "2025-03-13 10:00:00.500000", T0.replace(microsecond=500000)),
    ("timestamp64", "2025-03-13", datetime(2025, 3, 13)), ("timestamp64", "2025", datetime(1970, 1, 1, 0, 0, 0, 2025)),
    ("timestamp64", "12:30", WRONG), ("timestamp64", "2025-3-1", WRONG), ("timestamp64", "not-a-timestamp", WRONG),
]


@pytest.mark.parametrize("name", sorted({c[0] for c in CASES}))
def test_transforms(spark, name):
    cases = [c for c in CASES if c[0] == name]

    def build(x):
        parsed = transforms.transform(name, x)
        return parsed.value, parsed.error

    for (_, raw, want), (value, error) in zip(cases, evaluate(spark, [c[1] for c in cases], build)):
        assert error == (want == WRONG and want != raw or want is WRONG), raw
        if want is not WRONG:
            assert value == want, raw


def test_unknown_transform():
    with pytest.raises(ValueError, match="unsupported transform"):
        transforms.check_transform("uuid")


FLOATS = [
    (0.0, "0"), (-0.0, "-0"), (1.0, "1"), (1.25, "1.25"), (-1.5, "-1.5"), (100000.0, "100000"), (1e6, "1e+06"),
    (1234567.0, "1.234567e+06"), (1e21, "1e+21"), (0.0001, "0.0001"), (0.00001, "1e-05"), (1.5e-7, "1.5e-07"),
    (123.456, "123.456"), (1e100, "1e+100"), (float("inf"), "+Inf"), (float("-inf"), "-Inf"), (float("nan"), "NaN"),
    (None, None), (0.5, "0.5"), (999999.5, "999999.5"),
]


def test_float_text(spark):
    got = evaluate(spark, [f for f, _ in FLOATS], lambda x: [text.float_text(x)], "x double")
    assert [g[0] for g in got] == [t for _, t in FLOATS]


def test_stringify_and_escape(spark):
    assert evaluate(spark, ["a\tb\nc\rd", None, "plain\\"], lambda x: [text.escape_tsv(text.stringify_cell(x, T.StringType()))]) == [
        ("a\\tb\\nc\\rd",), ("",), ("plain\\",),
    ]
    times = evaluate(spark, [T0.replace(microsecond=120000), T0, None], lambda x: [text.stringify_cell(x, T.TimestampType())], "x timestamp")
    assert times == [("2025-03-13T10:00:00.12Z",), ("2025-03-13T10:00:00Z",), ("",)]
    assert evaluate(spark, [True, False, None], lambda x: [text.stringify_cell(x, T.BooleanType())], "x boolean") == [("true",), ("false",), ("",)]
    assert evaluate(spark, [bytearray(b"raw")], lambda x: [text.stringify_cell(x, T.BinaryType())], "x binary") == [("raw",)]


COERCIONS = [
    ("127", "string", "int8", 127), ("128", "string", "int8", None), (" 42 ", "string", "int32", 42),
    ("2147483648", "string", "int32", None), ("-1", "string", "uint8", None), ("255", "string", "uint8", 255),
    ("18446744073709551615", "string", "uint64", 2**64 - 1), (" true ", "string", "bool", True), ("yes", "string", "bool", None),
    (" 2.5 ", "string", "double", 2.5), ("x", "string", "float", None), ("2025-03-13 10:00:00", "string", "timestamp64", T0),
    ("1741860000000000", "string", "timestamp64", T0), ("hello", "string", "json", "hello"),
]


@pytest.mark.parametrize("raw,kind,target,want", COERCIONS)
def test_coerce_text(spark, raw, kind, target, want):
    def build(x):
        out = coerce.coerce(x, T.StringType(), target)
        return out.value, out.error

    [(value, error)] = evaluate(spark, [raw], build)
    assert (value, error) == (want, want is None)


def test_coerce_numbers(spark):
    def build(x):
        return [
            coerce.coerce(x, T.DoubleType(), t).value for t in ("int32", "uint16", "utf8", "timestamp64", "bool")
        ]

    got = evaluate(spark, [1e3, 1.5, -4.0, float("inf"), float("nan")], build, "x double")
    assert got == [
        (1000, 1000, "1000", None, None), (None, None, "1.5", None, None), (-4, None, "-4", None, None),
        (None, None, "+Inf", None, None), (None, None, "NaN", None, None),
    ]


def parsed(spark, messages, pattern, **kwargs):
    df = spark.createDataFrame([(i, m, "billing@07.service") for i, m in enumerate(messages)], "i int, message string, systemd_unit string")
    return {r.i: r.parsed for r in parse.parse_record(df, pattern, **kwargs).collect()}


def test_first_line_retry(spark):
    got = parsed(spark, ["2025-03-13T10:00:00 :nginx ERROR: request failed\nstack line 1\nstack line 2"], MESSAGE_PATTERN)
    assert got[0] == {
        "P_DTTM": "2025-03-13T10:00:00", "P_SERVICE": "nginx", "P_LEVEL": "ERROR",
        "P_MESSAGE": "request failed\nstack line 1\nstack line 2",
    }


def test_empty_body_and_empty_rest(spark):
    got = parsed(spark, [":a B: \nmore", ":a B: x\n", "no\nmatch"], r"^:(?P<S>\w+) (?P<L>\w+): (?P<P_MESSAGE>.*)$")
    assert got[0]["P_MESSAGE"] == "more"
    assert got[1]["P_MESSAGE"] == "x"
    assert got[2] == {}


def test_skip_and_send_raw(spark):
    args = {"unit_pattern": r"^(?P<TASK>[^@]+)@(?P<SLOT>.+)\.service$"}
    kept = parsed(spark, ["not a number", "42"], r"^(?P<P_NUM>\d+)$", no_match="skip", **args)
    assert kept == {1: {"P_NUM": "42", "TASK": "billing", "SLOT": "07"}}
    raw = parsed(spark, ["not a number"], r"^(?P<P_NUM>\d+)$", **args)
    assert raw == {0: {"TASK": "billing", "SLOT": "07"}}


def test_message_groups_and_existing_keys_win(spark):
    df = spark.createDataFrame(
        [("x y", "x-u", {"A": "old", "P_MESSAGE": "kept"}), ("x y\nz", "x-u", {"P_MESSAGE": "replaced"})],
        "message string, systemd_unit string, parsed map<string,string>",
    )
    out = parse.parse_record(df, r"^(?P<A>\w) (?P<P_MESSAGE>.*)$", r"^(?P<A>\w)-(?P<B>\w)$").collect()
    assert out[0].parsed == {"A": "old", "P_MESSAGE": "kept", "B": "u"}
    assert out[1].parsed == {"A": "x", "P_MESSAGE": "y\nz", "B": "u"}


def test_pattern_translation():
    assert compile_pattern(MESSAGE_PATTERN).groups == {"P_DTTM": 1, "P_SERVICE": 2, "P_LEVEL": 3, "P_MESSAGE": 4}
    assert compile_pattern(UNIT_PATTERN).java.endswith("service\\z")
    for bad in ("[", "(a", "a)", "(?=a)", r"(a)\1", "a**", "(?P<a>x)(?P<a>y)", "(?<!a)b"):
        with pytest.raises(PatternError):
            compile_pattern(bad)


def test_pattern_semantics(spark):
    def match(pattern, subject):
        df = spark.createDataFrame([(subject,)], "x string")
        return df.select(F.rlike("x", F.lit(compile_pattern(pattern).java))).first()[0]

    assert not match("a$", "a\n")
    assert match("(?m)^b$", "a\nb\nc")
    assert match("a.b", "a\rb") and not match("a.b", "a\nb")
    assert match("[[:alpha:]]+[[]x", "ab[x") and not match(r"\s", "\x0b")
    assert match("(?i)É", "é") and match("[]a]+", "]")


@pytest.mark.parametrize(
    "mask,unit,want",
    [
        ("cro*.service", "crond.service", True), ("cro*.service", "a/crond.service", False), ("*", "a/b", False),
        ("a?c", "abc", True), ("[^a]b", "cb", True), ("[^a]b", "ab", False), ("[a-c]x", "bx", True), ("[a", "a", False),
        ("nginx.service", "nginx.service", True), ("", "anything", True), (r"regex:^foo-[0-9]+\.service$", "foo-12.service", True),
        ("regex:oo-", "foo-12", True), ("a\\*[b]", "a*b", True), ("[c-a]", "b", False),
    ],
)
def test_unit_masks(spark, mask, unit, want):
    df = spark.createDataFrame([(unit,)], "systemd_unit string")
    assert (unit_filter(df, mask).count() == 1) == want


def test_bad_unit_mask(spark):
    df = spark.createDataFrame([("a",)], "systemd_unit string")
    with pytest.raises(PatternError):
        unit_filter(df, "regex:[")
    assert glob_to_java("[") is None


def test_value_lists():
    assert parse_lists(["level=INFO,WARN", "level=ERROR,INFO", "host=node-1"]) == {
        "level": ["INFO", "WARN", "ERROR"], "host": ["node-1"],
    }
    for bad in ("", "novalue", "bad field=1", "level="):
        with pytest.raises(ValueError):
            parse_lists([bad])


def test_intervals(spark):
    df = spark.createDataFrame([(T0,)], "ts_orig timestamp")
    assert time_range(df, "2025-03-13T10:00:00Z", "2025-03-13T10:00:01Z").count() == 1
    assert time_range(df, "2025-03-13T09:00:00Z", "2025-03-13T10:00:00Z").count() == 0
    for start, end in (("2025-03-13T10:00:00Z", "2025-03-13T10:00:00Z"), ("2025", "2026-01-01T00:00:00Z")):
        with pytest.raises(ValueError):
            time_range(df, start, end)
    with pytest.raises(ValueError, match="not found"):
        time_range(df, "2025-03-13T10:00:00Z", "2025-03-14T10:00:00Z", "other")
    assert parse_instant("2025-03-13T12:00:00.5+02:00").microsecond == 500000


def test_json_sizes(spark):
    import json

    messages = ["plain", "<b>& ", 'quote " and \\ and \t', "é漢😀", "\x01"]
    df = spark.createDataFrame([(m,) for m in messages], "message string").selectExpr(
        "message", "cast(null as map<string,string>) parsed", "cast(5 as bigint) seqno", "cast(null as int) priority",
        "'' syslog_identifier", "'' systemd_unit", "cast(null as bigint) realtime_ts", "map('k', message) fields",
    )
    for r in df.select("message", fields.record_json_bytes().alias("n")).collect():
        wire = json.dumps({"message": r.message, "seqno": 5, "fields": {"k": r.message}}, ensure_ascii=False, separators=(",", ":"))
        for ch in "<>& ":
            wire = wire.replace(ch, f"\\u{ord(ch):04x}")
        assert r.n == len(wire.encode())


def test_fingerprint_ignores_key_order(spark):
    df = spark.sql(
        "select 'm' message, map('a','1','b','2') fields, cast(null as map<string,string>) parsed, 1 priority, "
        "2L realtime_ts, 3L seqno, 's' syslog_identifier, 'u' systemd_unit"
    )
    other = df.withColumn("fields", F.expr("map('b','2','a','1')"))
    hashes = {d.select(fields.payload_fingerprint()).first()[0] for d in (df, other)}
    assert len(hashes) == 1
    assert df.withColumn("seqno", F.lit(4)).select(fields.payload_fingerprint()).first()[0] not in hashes


@pytest.mark.parametrize("pattern", [r"(?P<A>b+)(?P<B>x)?", r"(?i)(?P<B>[a-c])|(?P<A>zz)", r"^(?P<A>.*)$", r"b", r"(?P<A>)(b*)(?P<B>c*)", r"(?m)^(?P<A>b.*)$"])
def test_one_match_gives_what_extracting_each_group_gives(spark, pattern):
    compiled = compile_pattern(pattern)
    texts = ["", "b", "aabbx bbb", "zz top", "a\nbxc", "no\n\nb", "$1 \\ b", "é\U0001f600b", "x\uffffbb", "\uffff", "\n", "aB" * 50, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, message string")
    got = {r.i: r for r in parse.parse_message(df, pattern).collect()}
    for i, text in enumerate(texts):
        lines = [] if text is None else [text, *([text.split("\n")[0]] if "\n" in text else [])]
        java = [(t, spark._jvm.java.util.regex.Pattern.compile(compiled.java).matcher(t)) for t in lines]
        hit = next((m for _, m in java if m.find()), None)
        assert got[i].matched == (hit is not None)
        want = {n: hit.group(g) for n, g in compiled.named if hit.group(g)} if hit else {}
        assert got[i].parsed == want


def test_a_line_is_matched_once(spark):
    df = spark.createDataFrame([("a b", "u-v")], "message string, systemd_unit string")
    out = parse.parse_record(df, r"^(?P<A>\w) (?P<B>\w)$", r"^(?P<C>\w)-(?P<D>\w)$", "skip")
    plan = out.filter("parsed['A'] = 'a'")._jdf.queryExecution().executedPlan().toString()
    # The whole text, its first line where that fails, and the unit.
    assert len(re.findall(r"Generate explode\(", plan)) == 3
    assert all(line.count("regexp_replace") <= 1 for line in plan.splitlines())
    assert plan.count("regexp_replace") == 3
