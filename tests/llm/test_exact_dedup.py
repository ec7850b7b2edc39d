import hashlib
import re

import duckdb
import pytest

from ledgerline.llm import exact_dedup as xd


def brute_force(rows):
    """rows: (doc_id, text) -> sorted (doc_id, keep_id, group_size, kept, sha)."""
    groups = {}
    for k, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((k, len(t or "")))
    out = []
    for bare, mine in groups.items():
        mine.sort(key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        sha = hashlib.sha256(bare.encode()).hexdigest()
        out += [(k, mine[0][0], len(mine), n == 0, sha) for n, (k, _) in enumerate(mine)]
    return sorted(out, key=str)


def corpus():
    rows = [(k, f"text {k % 90}" + " " * (k % 4)) for k in range(300)] + [(1000 + k, "same copy " * 30) for k in range(200)]
    rows += [(2000, None), (2001, ""), (2002, " \t\r\n\x0b\x0c"), (2003, " "), (2004, "a\x1cb"), (2005, "ab"), (2006, "a b"), (2007, "é漢🙂"), (2008, "é 漢 🙂")]
    rows += [(None, "no id"), (None, "no id"), (3000, "noid"), (4, "text 4"), (4, "text 4"), (5, "other text, same id"), (3001, "x" * 300000), (3002, "x" * 299999 + "y")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", k) for k, t in rows], "doc_id long, text string, kept string, id long")


@pytest.mark.parametrize("bits", [64, 1 << 22])
def test_equals_one_list(spark, bits):
    rows = corpus()
    got = xd.exact_groups(frame(spark, rows), digest_all=True, bits=bits).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str) == brute_force(rows)


def test_rounds_leave_out_unique_texts(spark):
    got = {r.doc_id: r.text_sha256 for r in xd.exact_groups(frame(spark, [(1, "one"), (2, "three"), (3, "two"), (4, "t wo")])).collect()}
    assert got[2] is None and got[3] == got[4] is not None


@pytest.mark.parametrize("bits", [64, 1 << 22])
def test_rows_that_stay(spark, bits):
    rows = corpus()
    docs = frame(spark, rows)
    stay = xd.drop_exact_duplicates(docs, bits)
    assert stay.columns == docs.columns
    assert sorted((str(r.doc_id) for r in stay.collect())) == sorted(str(w[0]) for w in brute_force(rows) if w[3])


def test_suspects_are_read_once(spark, capsys):
    """Rows that surely stay and suspects: two scans, whatever is decided about the suspects."""
    xd.drop_exact_duplicates(frame(spark, corpus())).explain()
    assert capsys.readouterr().out.count("Scan ExistingRDD") == 2


def test_empty_table(spark):
    assert xd.exact_groups(frame(spark, [])).count() == 0
    assert xd.drop_exact_duplicates(frame(spark, [])).count() == 0


def test_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = sorted(tuple(r) for r in xd.op2_exact_dedup(spark, sf).collect())
    assert got == sorted(con.execute(xd.ORACLE).fetchall())
