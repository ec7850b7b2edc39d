import hashlib
import re

import duckdb
import pytest

from ledgerline.llm import mixing as mx

SCHEMA = "doc_id long, text string, source string, size string, name string"


def brute_force(rows, weights=(1, 2, 3), most=3):
    """rows: (doc_id, text, source) -> sorted (doc_id, source, size, source_size, target, taken)."""
    sized = [(k, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for k, t, s in rows]
    names = sorted({s for _, s, _ in sized if s is not None}) + [None] * any(s is None for _, s, _ in sized)
    total = {n: sum(z for _, s, z in sized if s == n) for n in names}
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, full = {}, set()
    while len(full) < len(names):
        left = sum(total.values()) - sum(most * total[n] for n in full)
        share = left / sum(weight[n] for n in names if n not in full)
        over = {n for n in names if n not in full and weight[n] * share >= most * total[n]}
        if not over:
            target.update({n: weight[n] * share for n in names if n not in full})
            break
        full |= over
    target.update({n: float(most * total[n]) for n in full})
    out = []
    for n in names:
        epochs, rest = divmod(round(target[n]), total[n]) if total[n] else (0, 0)
        mine = sorted((hashlib.md5(f"mix:{'' if k is None else k}".encode()).hexdigest(), k is not None, k or 0, z) for k, s, z in sized if s == n)
        for _, has, k, z in mine:
            part = max(0, min(z, rest))
            rest -= part
            out.append((k if has else None, n, z, total[n], target[n], epochs * z + part))
    return sorted(out, key=str)


def corpus():
    rows = [(k, "w " * (k % 37), f"s{k % 5}") for k in range(400)]
    rows += [(1000 + k, "big words here " * 50, "huge") for k in range(60)]
    rows += [(None, "no id", None), (None, None, "s1"), (5000, "", None), (5001, None, "empty"), (5002, "\t\n ", "empty")]
    rows += [(7, "same row twice", "s2")] * 2 + [(6000, "tiny", "a"), (6001, "x y", "é"), (6002, "word " * 40000, "long")]
    return rows


@pytest.mark.parametrize("per_bucket", [1, 3, 2000])
def test_equals_one_list(spark, per_bucket):
    docs = spark.createDataFrame([(k, t, s, "x", "y") for k, t, s in corpus()], SCHEMA)
    got = mx.mix_sources(docs, rows_per_bucket=per_bucket).collect()
    want = brute_force(corpus())
    got = sorted(((r.doc_id, r.source, r.size, r.source_size, r.target, r.taken) for r in got), key=str)
    assert [g[:4] + g[5:] for g in got] == [w[:4] + w[5:] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])


def test_sums_meet_targets(spark):
    docs = spark.createDataFrame([(k, t, s, "x", "y") for k, t, s in corpus()], SCHEMA)
    rows = mx.mix_sources(docs).collect()
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert sum(r.taken for r in mine) == pytest.approx(mine[0].target, abs=1)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)


def test_repeated_rows(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, s, "x", "y") for k, t, s in rows], SCHEMA)
    got = mx.repeat_to_mix(docs, rows_per_bucket=20)
    assert got.columns == docs.columns
    counts = {}
    for r in got.collect():
        counts[(r.doc_id, r.source)] = counts.get((r.doc_id, r.source), 0) + 1
    for k, source, size, _, _, taken in brute_force(rows):
        if k is not None and k != 7:
            assert counts.get((k, source), 0) == ((2 * taken + size) // (2 * size) if size else 0)


@pytest.mark.parametrize("same_text", [False, True])
def test_rows_without_id_are_cut_apart(spark, same_text):
    """One id for nine tenths of the rows, or all rows the same: targets are met within one row."""
    rows = [(None, "ten words of a row that has no id " + ("here" if same_text else str(k)), "a") for k in range(300)]
    rows += [(k, "other words of some row " * 3, s) for k in range(30) for s in ("a", "b", "c")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    wanted = {s: t for _, s, _, _, t, _ in brute_force(rows)}
    got, words = mx.repeat_to_mix(docs, rows_per_bucket=7), {}
    for r in got.collect():
        words[r.source] = words.get(r.source, 0) + len(r.text.split())
    for source, target in wanted.items():
        assert abs(words[source] - target) <= 15, source


def test_few_rows(spark):
    for rows in ([], [(1, None, None)], [(1, "a b c", "s")]):
        docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
        got = mx.mix_sources(docs).collect()
        assert sorted(((r.doc_id, r.source, r.size, r.source_size, r.target, r.taken) for r in got), key=str) == brute_force(rows)
        assert mx.repeat_to_mix(docs).count() == sum(bool(r[1]) for r in rows)


def test_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = sorted(tuple(r) for r in mx.op6_mix_sources(spark, sf).collect())
    assert got == sorted(con.execute(mx.ORACLE).fetchall())
