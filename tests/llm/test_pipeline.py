import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from ledgerline.llm import quality as q
from ledgerline.session import stage

from .test_exact_dedup import brute_force as exact
from .test_jaccard import brute_force as near
from .test_mixing import brute_force as mixed
from .test_quality import fit_plainly


def plainly(docs, labels):
    """docs: rows of documents; the stages in lists; sorted (doc_id, n_tokens, ids_sha256)."""
    rows = [(d.doc_id, d.text, d.source) for d in docs]
    model = fit_plainly([r[:2] for r in rows], [(r.doc_id, r.quality) for r in labels])
    rows = [r for r in rows if model.scores(np.array([q.statistics(r[1] or "")]))[0] >= 0.7]
    stay = {w[0] for w in exact([r[:2] for r in rows]) if w[3]}
    rows = [r for r in rows if r[0] in stay]
    stay = {w[4] for w in near([r[:2] for r in rows])}
    rows = [r for r in rows if r[0] in stay]
    times = {k: (2 * taken + size) // (2 * size) if size else 0 for k, _, size, _, _, taken in mixed(rows)}
    library = Tokenizer.from_file(public_tokenizers.path(cp.VOCABULARY))
    out = []
    for k, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out += [(k, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())] * times[k]
    return sorted(out)


def test_run_equals_lists(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "labels"))
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in cp.run(spark, sf).collect())
    assert got == plainly(docs, labels)


def test_stages_keep_columns_and_survive_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "no id", "en", None, 5), (-1, "", "en", "s", 0), (-2, "w " * 50000, None, "s", 1), (-2, "w " * 50000, None, "s", 1)],
        docs.schema,
    )
    docs = docs.unionByName(odd).selectExpr("*", "doc_id AS row", "text AS score", "n_chars AS node")
    for frame in (docs, docs.limit(0)):
        for name, apply in cp.STAGES:
            before, frame = frame.columns, stage(apply(spark, frame, sf), f"test-{name}")
            assert name == "bpe" or frame.columns == before
            assert frame.count() >= 0


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "bpe"]


@pytest.mark.parametrize("name", ["pipeline", "op8_bpe_roundtrip"])
def test_registered(name):
    from __spark_entry__ import queries

    assert name in queries()


def test_last_stage_keeps_ids_and_text(spark, sf):
    rows = [(1, "Some words, then others."), (2, None), (3, "long " * 40000), (None, "ü 漢")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    library = Tokenizer.from_file(public_tokenizers.path(cp.VOCABULARY))
    got = {r.doc_id: r for r in cp.encode(spark, docs, sf).collect()}
    for k, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(got[k].ids) == ids and got[k].n_tokens == len(ids) and got[k].decoded == (text or "")
        assert got[k].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
