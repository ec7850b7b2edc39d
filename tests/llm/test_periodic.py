import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ledgerline.llm import periodic as p


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i + q] for i in range(len(words) - q)))


def plain_runs(words, min_words=24, exponent=3):
    """Every maximal stretch of every diagonal, kept if its lag is its smallest period."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_words, exponent * q) and smallest_period(words[i : j + q]) == q:
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_rows(rows):
    """The contract, word by word."""
    out = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        if doc_id is not None and n:
            h = zlib.crc32(str(doc_id).encode())
            g = h // 10
            if h % 10 == 0:
                a = g % n
                size = 1 + (n - a) // (3 + g % 8)
                words = [words[i] if i < a else words[a + (i - a) % size] for i in range(n)]
        runs = plain_runs(words)
        lost = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = None
        for run in runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out.append(
            (
                doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
                sha(" ".join(w for i, w in enumerate(words) if i not in lost)),
            )
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_all_diagonals(seed):
    rng = random.Random(seed)
    words = []
    while len(words) < 260:
        piece = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 50))]
        words += piece * rng.choice([1, 1, 2, 3, 4, 7])
        words += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.3:
            words += words[: rng.randint(1, 40)]
    ids = np.array([ord(w) for w in words])
    for min_words, exponent in ((24, 3), (6, 3), (1, 4), (40, 5)):
        assert p.find_runs(ids, min_words, exponent) == plain_runs(words, min_words, exponent)


def test_long_periods_and_one_word():
    rng = np.random.default_rng(1)
    piece = rng.integers(0, 1000, 700)
    ids = np.concatenate((rng.integers(0, 1000, 50), np.tile(piece, 3), piece[:11], [5000]))
    assert p.find_runs(ids) == [(50, 2111, 700)]
    assert p.find_runs(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]
    # A period that holds a repeated passage longer than the first grams.
    passage = rng.integers(0, 9, 40)
    piece = np.concatenate((passage, [100], passage, [101, 102]))
    assert p.find_runs(np.tile(piece, 4)) == [(0, 4 * len(piece), len(piece))]


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(map(tuple, p.op12_periodic_runs(spark, sf).collect()), key=str)
    assert got == plain_rows([(d.doc_id, d.text) for d in docs])
    assert sum(r[1] for r in got) > 10


def test_defined_cases(spark, tmp_path):
    rows = [(i, t, "x", 1) for i, t in enumerate(
        ["a b " * 40, None, "", " \t\n", "one", "w " * 24, "w " * 23, " x  y　z", "über\x0bx\x0cy " * 12, "a b " * 40]
    )]
    rows += [(0, "a b " * 40, "x", 1), (None, "c d e " * 30, "x", 2), (None, None, None, None), (7, "l o n g " * 60_000, "x", 3)]
    rows += [(i, "p q r s t u v w x y z " * 9, "x", 4) for i in range(100, 160)]
    spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").write.parquet(f"{tmp_path}/documents.parquet")
    got = p.op12_periodic_runs(spark, str(tmp_path)).collect()
    small = [r for r in rows if r[1] is None or len(r[1]) < 1000]
    assert sorted((tuple(r) for r in got if (r.length or 0) < 1000), key=str) == plain_rows([(r[0], r[1]) for r in small])
    assert [(r.start, r.length, r.exponent_milli) for r in got if (r.length or 0) > 1000] == [(0, 240_000, 60_000_000)]
    shown = p.periodic_runs(spark.read.parquet(f"{tmp_path}/documents.parquet").filter("doc_id = 0")).collect()
    assert {(r.n_words, r.collapsed) for r in shown} == {(80, "a b")}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = p.op12_periodic_runs(spark, str(tmp_path))
    assert out.collect() == [] and out.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    with pytest.raises(ValueError):
        p.periodic_runs(spark.read.parquet(f"{tmp_path}/documents.parquet"), min_exponent=2)
