import duckdb
import pytest

from ledgerline.llm import lines as ln

SCHEMA = "doc_id long, text string, source string, line string, lost string"


def brute_force(rows, min_sites=5):
    bare = lambda x: x.strip(ln.BLANKS)
    sites = {}
    for _, t, s in rows:
        for x in (t or "").split("\n"):
            sites.setdefault(bare(x), set()).add(s)
    lost = {x for x, s in sites.items() if x and len(s) >= min_sites}
    out = []
    for k, t, _ in rows:
        every = (t or "").split("\n")
        left = [x for x in every if bare(x) not in lost]
        out.append((k, len(every), len(every) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def corpus():
    rows = []
    for k in range(600):
        lines = [f"own line {k}", f"  at {k % 40 % 9} sites\t" if k % 3 else "", f"spread {k % 7}", "everywhere" if k % 2 else " \t "]
        rows.append((k, "\n".join(lines), f"s{k % 40 % (1 + k % 9)}"))
    rows += [(None, "everywhere", None), (None, None, None), (1000, "", "s1"), (1001, "everywhere\neverywhere", "s2"), (5, "repeat\neverywhere\n", "s3"), (5, "repeat\neverywhere\n", "s3")]
    rows += [(2000, "word " * 60000 + "\neverywhere\r\n\n", "s4"), (2001, "\n\n\n", "s5"), (2002, "no\x85break here", "s6")]
    rows += [(3000 + k, f"edge {n}", f"t{k}") for n in range(1, 13) for k in range(n)]
    return rows


@pytest.mark.parametrize("min_sites,bits", [(5, 1 << 22), (2, 64), (8, 1 << 10)])
def test_equals_one_list(spark, min_sites, bits):
    docs = spark.createDataFrame([(*r, "x", "y") for r in corpus()], SCHEMA)
    got = ln.drop_shared_lines(docs, min_sites, bits=bits).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_force(corpus(), min_sites)


def test_sketches_decide_far_from_the_threshold(spark):
    """Only estimates in the band are counted: with a band of 0 the sketch alone decides."""
    rows = [(k, f"line {n}", f"t{k}") for n in (1, 30, 400) for k in range(n)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = ln.drop_shared_lines(docs, 100, band=0.0).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_force(rows, 100)


def test_empty_table(spark):
    assert ln.drop_shared_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = sorted(tuple(r) for r in ln.op3_line_dedup(spark, sf).collect())
    assert got == sorted(con.execute(ln.ORACLE).fetchall())
