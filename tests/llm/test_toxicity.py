import itertools
import zlib

import numpy as np
import pytest

from ledgerline.llm import toxicity as tx


def test_marginals_equal_summing_over_all_taggings():
    chain = tx.Chain({}, -0.7, ((0.4, -0.3), (-0.6, 0.9)))
    for emissions in ([None], [1.5, None, -0.2], [None, 2.0, 0.3, None, -1.0, 0.8]):
        local = [chain.bias + (e or 0.0) for e in emissions]
        total, toxic = 0.0, np.zeros(len(local))
        for tags in itertools.product((0, 1), repeat=len(local)):
            weight = sum(x for x, t in zip(local, tags) if t) + sum(chain.moves[a][b] for a, b in zip(tags, tags[1:]))
            total += np.exp(weight)
            toxic += np.exp(weight) * np.array(tags)
        assert chain.marginals(emissions) == pytest.approx(toxic / total)
    assert len(chain.marginals([])) == 0


def test_fit_finds_words_and_neighbours():
    r = np.random.default_rng(1)
    sequences = []
    for _ in range(300):
        tags = [int(r.random() < 0.1)]
        for _ in range(30):
            tags.append(int(r.random() < (0.7 if tags[-1] else 0.05)))
        sequences.append(([[0] if t and r.random() < 0.9 else [1] if r.random() < 0.3 else [] for t in tags], tags))
    chain = tx.fit_chain(sequences, ["bad", "plain"])
    assert chain.weights["bad"] > 2 > 0 > chain.weights["plain"]
    assert chain.moves[1][1] + chain.moves[0][0] > chain.moves[0][1] + chain.moves[1][0]
    p = chain.marginals([None, chain.weights["bad"], None, None, None])
    assert p[1] > 0.8 and p[2] > p[4]


@pytest.fixture(scope="module")
def tagged(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    return truth, tx.op10_toxicity(spark, sf).collect(), spark.read.parquet(f"{sf}/documents.parquet").collect()


def test_held_out_rows(tagged):
    truth, rows, docs = tagged
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert sum(a and b for a, b in held) >= 0.8 * sum(a for a, _ in held)


def test_spans_are_words_of_the_text(tagged):
    _, rows, docs = tagged
    text = {d.doc_id: d.text for d in docs}
    spans = [(r.doc_id, s) for r in rows for s in r.spans]
    assert spans and all(tx.WORD.fullmatch(text[k][s.start : s.end]) and s.marginal >= 0.5 for k, s in spans)


def test_odd_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    odd = [(1, None, "a"), (1, "", "a"), (2, "word " * 60000, "b"), (None, "idiot and moron", "c"), (4, "x", None), (4, "x", None), (6, "!!!", "d")]
    docs = spark.createDataFrame(odd, "doc_id long, text string, score string")
    got = tx.toxic_spans(docs, labels).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    assert tx.toxic_spans(docs.limit(0), labels).count() == 0
    assert {r.score for r in tx.toxic_spans(docs, labels.limit(0)).collect()} == {0.0}
