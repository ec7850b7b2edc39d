import random
import re

import pytest

from ledgerline.llm import common
from ledgerline.llm import jaccard as jc
from ledgerline.llm.components import components


def word_sets(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute_force(rows):
    """rows: (doc_id, text) -> (doc_id, rep_id, copies, n_links, class_id) by comparing all."""
    sets = {}
    for k, t in rows:
        sets.setdefault(word_sets(t), []).append(k)
    keys = list(sets)
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    links = {s: set() for s in keys}
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            common = len(a & b)
            if common and common >= 0.8 * (len(a) + len(b) - common) - 1e-9:
                links[a].add(b)
                links[b].add(a)
    klass = {}
    for s in keys:
        if s not in klass:
            group, todo = {s}, [s]
            while todo:
                for x in links[todo.pop()] - group:
                    group.add(x)
                    todo.append(x)
            for x in group:
                klass[x] = low([i for y in group for i in sets[y]])
    return sorted(((k, low(sets[s]), len(sets[s]), len(links[s]), klass[s]) for s in keys for k in sets[s]), key=str)


def result(df):
    return sorted(((r.doc_id, r.rep_id, r.copies, r.n_links, r.class_id) for r in df.collect()), key=str)


def corpus(seed=1, near=90, passages=80, alone=60):
    """A large group of near copies, a passage in many texts, copies, short and empty texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    base, passage, rows = text(160), text(30), []
    for _ in range(near):
        t = list(base)
        for _ in range(r.choice((0, 1, 1, 2, 3))):
            t[r.randrange(len(t))] = word()
        rows.append(" ".join(t))
    rows += [" ".join(text(r.randrange(20, 80)) + passage + text(r.randrange(5, 60))) for _ in range(passages)]
    rows += [" ".join(text(r.randrange(1, 90))) for _ in range(alone)]
    rows += [rows[-1]] * 5 + [rows[0].upper()] * 3 + [None, "", " \n\t ", "?!", "one", "One.", "naïve — é", "NAÏVE  — É!", "one two three", "one two three four"]
    for t in [x for x in rows[near + passages :] if x and len(x.split()) > 40][:20]:
        rows.append(t + " tail")
    rows = list(enumerate(rows, 100))
    return rows + [(None, "no id here at all"), (None, rows[0][1]), (7, rows[100][1]), rows[5], rows[5]]


@pytest.mark.parametrize("small,block", [(50, 512), (6, 16)])
def test_equals_comparing_all(spark, small, block):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, b"x") for k, t in rows], "doc_id long, text string, node binary")
    assert result(jc.near_classes(docs, small=small, block=block)) == brute_force(rows)


def test_few_rows(spark):
    for rows in ([], [(1, None)], [(1, "a b"), (1, "a b"), (None, "a  b")]):
        assert result(jc.near_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_force(rows)


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert result(jc.op5_jaccard_join(spark, sf)) == brute_force([tuple(r) for r in docs.collect()])


def test_one_of_each_class_stays(spark):
    rows = [(k, t) for k, t in corpus() if k is not None]
    docs = spark.createDataFrame([(k, t, k) for k, t in rows], "doc_id long, text string, _class long")
    stay = jc.drop_near_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted({r[4] for r in brute_force(rows)})


@pytest.mark.parametrize("bits", [64, 1 << 22])
def test_odd_rows_that_stay(spark, bits):
    """Null ids, ids with two texts, rows that come again; by few bits all rows are suspects."""
    same, other = "one two three four five six seven", "quite another text of six words"
    rows = [(1, same), (1, same), (1, other), (2, same), (None, same), (None, "no id here"), (None, "no id here"), (3, "alone"), (4, None), (5, ""), (6, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stay = sorted(map(tuple, jc.drop_near_duplicates(docs, bits).collect()), key=str)
    assert stay == sorted([(1, same), (1, other), (None, "no id here"), (3, "alone"), (4, None)], key=str)


def test_digests_are_computed_once(spark, capsys):
    """One Python worker a task: each evaluation in a stage takes a worker of its own, which the executor keeps."""
    rows = [(k, t, k) for k, t in corpus()]
    jc.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, n long")).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_components(spark):
    r = random.Random(3)
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(2000 + r.randrange(99), 2000 + r.randrange(99)) for _ in range(80)]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for a in sorted(near):
        todo = [a] if a not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = a
                todo += near[x]
    assert got == want


def test_stars_on_few_edges_do_not_shuffle(spark, monkeypatch):
    """A job for each table that is written, not one more for each shuffle; many edges shuffle as before."""
    edges = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40) if i % 13], "u string, v string")
    want = sorted((n, f"n{max(k for k in (1, 14, 27) if k <= int(n[1:])):03d}") for n in {x for r in edges.collect() for x in r})
    written, stage = [], common.Workings.stage
    monkeypatch.setattr(common.Workings, "stage", lambda self, *a, **k: written.append(1) or stage(self, *a, **k))
    few, jobs = common.ROWS_IN_ONE, {}
    for rows in (few, 0):
        monkeypatch.setattr(common, "ROWS_IN_ONE", rows)
        written.clear()
        spark.sparkContext.setJobGroup(f"stars {rows}", "")
        found = components(edges)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs[rows] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"stars {rows}")) / len(written)
        assert sorted(map(tuple, found.collect())) == want
    # The edges as they are given are made distinct in one shuffle.
    assert jobs[few] < 1.5 and jobs[0] > 2
