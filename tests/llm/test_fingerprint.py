import hashlib

from ledgerline.llm import fingerprint as fp


def brute_force(rows):
    """rows: (doc_id, text), by the definition, in one list."""
    rows = sorted(((k if k is not None else fp.NULL_ID, k, t or "") for k, t in rows), key=lambda r: (-r[0], r[2]))
    out = []
    for n, (_, k, own) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][2]
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        a, b, c = (fp.chunk_sets([t.encode()])[0] for t in (own, changed, following))
        out.append(
            (str(k), len(own), hashlib.sha256(changed.encode()).hexdigest(), fp.as_text(a), fp.as_text(b), fp.likeness(a, b), fp.likeness(a, c))
        )
    return sorted(out)


def result(df):
    return sorted(
        (str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect()
    )


def test_neighbours_over_ranges(spark):
    rows = [(7 * k, f"text {k} " * (k % 40)) for k in range(300)]
    rows += [(None, "no id"), (14, "same id again"), (14, "same id again"), (3, None), (-5, ""), (10**12, "é漢🙂" * 500)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, key string")
    for ranges in (1, 2, 5, 64):
        assert result(fp.neighbour_fingerprints(docs, ranges)) == brute_force(rows)


def test_few_rows(spark):
    for rows in ([], [(1, "alone " * 30)], [(None, None)], [(1, "a"), (1, "a")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert result(fp.neighbour_fingerprints(docs)) == brute_force(rows)


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(fp.op7_fingerprints(spark, sf)) == brute_force(rows)


def test_an_insertion_changes_few_chunks(sf):
    import pandas as pd

    for text in pd.read_parquet(f"{sf}/documents.parquet")["text"]:
        if len(text) > 3000:
            near = text[:1000] + "inserted words" + text[1000:]
            a, b = fp.chunk_sets([text.encode(), near.encode()])
            assert fp.likeness(a, b) > 1 - 3 * fp.MAX_BYTES / len(text.encode())


def test_chunks_do_not_depend_on_the_batch():
    many = [("word %d " % k * (k % 50)).encode() for k in range(200)]
    assert all((a == b).all() for a, b in zip(fp.chunk_sets(many), (fp.chunk_sets([t])[0] for t in many)))


def test_plain_fingerprints(spark):
    docs = spark.createDataFrame([(1, "a b c " * 20), (2, "a b c " * 20), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in fp.fingerprints(docs).collect()}
    assert got[1] == got[2] != "" and got[3] == got[4] == ""
