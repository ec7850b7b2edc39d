import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import search as s
from ledgerline.llm.common import texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: chr(c + 32) for c in range(65, 91)}


def plain(docs, items, k=50):
    """Every query against every document: (item_id, rank, doc_id, score)."""
    bags = [(i, Counter(TERM.findall((t or "").translate(UPPER)))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total, words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 50 + 50 * sum(bag.values()) * total // words
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
                for t in set(TERM.findall((text or "").translate(UPPER))) if t in bag
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        ranked = sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k]
        out += [(item, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(ranked, 1)]
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = shown(s.op11_ranked_search(spark, sf))
    assert got == plain(docs, items) and len(got) > 1000


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Äß", "ZWÖLF", "x_y", "a-b", "第一"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))) for i in range(150)]
    # Copies (ties), repeated rows, no terms, null ids and a long text.
    docs += [(i + 500, docs[0][1]) for i in range(30)] + [docs[1]] * 3 + [(None, docs[2][1]), (None, None), (7, ""), (8, " -- !? \x00")]
    docs += [(9000, " ".join(rng.choices(vocabulary, k=50_000)))]
    items = [(1, docs[0][1]), (2, "w1 W2, w3!"), (2, "w1 W2, w3!"), (3, None), (4, ""), (5, "nowhere"), (None, "第一 äß"), (6, "zwÖlf ZWÖlf w5")]
    items += [(10 + i, " ".join(rng.choices(vocabulary, k=6))) for i in range(20)]
    return docs, items


@pytest.mark.parametrize("coords,k,block", [(4096, 50, 256), (8, 5, 4), (1, 3, 256), (64, 500, 7)])
def test_any_sketch_gives_all_pairs(spark, cases, monkeypatch, coords, k, block):
    docs, items = cases
    monkeypatch.setattr(s, "ITEMS_PER_BLOCK", block)
    frame = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, terms string, n int")
    asked = spark.createDataFrame([(*i, "z", 1.0) for i in items], "item_id long, text string, item string, score double")
    index = s.build_index(frame.repartition(3), coords)
    assert shown(s.search(index, asked, k, coords)) == plain(docs, items, k)


def test_bounds_save_work_and_are_never_below(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    queries = [(i, sorted(set(s.terms_of(t))), [1000] * len(set(s.terms_of(t)))) for i, t in items]
    batches = pa.Table.from_pandas(texts(docs).toPandas()).to_batches()
    index = pa.Table.from_batches(list(s._describe(4096)(iter(batches)))).to_pydict()
    m = 50 + np.array(index["n"]) * 50 * len(index["n"]) // sum(index["n"])
    block = s._Block(queries, 4096, 5)
    bounds = block.bounds(m, index["coords"], index["peaks"])
    for r in range(len(m)):
        tf = dict(zip(index["terms"][r].encode().split(b" "), np.frombuffer(index["counts"][r], "<u4").tolist()))
        for q, (_, terms, weights) in enumerate(queries):
            exact = sum(w * (10**9 * tf[t] // (1000 * tf[t] + 20 * int(m[r]))) for t, w in zip(terms, weights) if t in tf)
            assert bounds[r, q] >= exact
    block.see(index["doc_id"], m, bounds, index["terms"], index["counts"])
    assert block.scored < 0.25 * bounds.size


def test_empty_tables(spark, cases):
    docs, items = cases
    full = spark.createDataFrame(docs[:5], "doc_id long, text string")
    asked = spark.createDataFrame(items[:2], "item_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    blank = spark.createDataFrame([(1, None), (2, "  ")], "doc_id long, text string")
    assert s.search(s.build_index(none), asked).collect() == []
    assert s.search(s.build_index(blank), asked).collect() == []
    assert s.search(s.build_index(full), spark.createDataFrame([], "item_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        s.build_index(full, 1000)
