import zlib

import numpy as np
import pytest

from ledgerline.llm import quality as q


def fit_plainly(rows, labels):
    """rows: (doc_id, text); labels: (doc_id, 0/1); the same model in one list."""
    moments = {}
    for k, label in labels:
        if zlib.crc32(str(k).encode()) % 4 == 2 or label is None:
            continue
        for i, t in rows:
            if i == k:
                x = np.array(q.statistics(t or ""))
                n, s, p = moments.get(label, (0, 0, 0))
                moments[label] = (n + 1, s + x, p + np.outer(x, x))
    return q.discriminant(moments)


@pytest.fixture(scope="module")
def tables(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_scores_equal_a_plain_fit(spark, sf, tables):
    docs, labels = (t.collect() for t in tables)
    rows = [(d.doc_id, d.text) for d in docs]
    model = fit_plainly(rows, [(r.doc_id, r.quality) for r in labels])
    want = {k: float(model.scores(np.array([q.statistics(t or "")]))[0]) for k, t in rows}
    got = q.op4_quality(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-6)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.7)


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(truth[r.doc_id], r.predicted, r.score) for r in q.op4_quality(spark, sf).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b, _ in held]) > 0.96
    good, bad = [s for a, _, s in held if a], [s for a, _, s in held if not a]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.98


def test_keep_quality_keeps_columns_and_good_rows(spark, tables):
    docs, labels = tables
    wide = docs.withColumns({"score": docs.doc_id, "label": docs.text})
    kept = q.keep_quality(wide, labels)
    assert kept.columns == wide.columns
    scores = {r.doc_id: r.predicted for r in q.quality_scores(docs, labels).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, p in scores.items() if p)


def test_odd_rows(spark, tables):
    _, labels = tables
    odd = [(1, None, "a"), (1, "", "a"), (2, "word " * 30000, "b"), (None, "no id here", "c"), (3, "x", None), (3, "x", None)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, score string")
    got = q.quality_scores(docs, labels).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert q.quality_scores(docs.limit(0), labels).count() == 0
    assert {r.score for r in q.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    ones = labels.limit(0).unionByName(spark.createDataFrame([(3, 1, 0), (3, None, None)], labels.schema))
    assert {r.score for r in q.quality_scores(docs, ones).collect()} == {1.0}
