"""Line dedup: remove lines that many sites share.

Lines are compared by a hash of the line without white space at its ends. The
spread of a line is its number of distinct sites (sources). Lines of one site
need no sketch (least and greatest site are equal); the others get a HyperLogLog
sketch each, merged by aggregation. Estimates clearly below or above the
threshold decide at once; lines in between get an exact distinct count. A line
at ``MIN_SITES`` sites or more is boilerplate and leaves every document.

Hashes and sites are narrow rows; texts move once, and only those of documents
that surely or maybe lose a line. Aggregations are partial before each shuffle,
so a line that a third of all documents share is a few rows.

Defined cases: null text counts as empty; a null source is a site of its own;
blank lines stay; rows equal in id lose the same lines; a document may end up
empty; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import FILTER_BITS, Workings, membership, query, table, with_maybe

BLANKS = " \t\n\x0b\x0c\r"
MIN_SITES = 5
#: Sketches have 2^LG_K registers; with 10, one standard error is 3 to 4 percent.
LG_K = 10
#: Estimates this close to the threshold (as a share of it) are counted exactly.
BAND = 0.3


def line_hash(line):
    return F.xxhash64(F.btrim(line, F.lit(BLANKS)))


def shared_lines(rows: DataFrame, min_sites: int = MIN_SITES, band: float = BAND, bits: int = FILTER_BITS) -> DataFrame:
    """(line) hashes seen at ``min_sites`` sites or more, from stored (line, site) rows."""
    work = Workings("lines")
    spread = rows.groupBy("line").agg(F.min("site").alias("first"), F.max("site").alias("last"))
    several = membership(spread.filter("first < last"), ["line"], bits)
    sketches = (
        with_maybe(rows, ["line"], several, "maybe", bits).filter("maybe")
        .groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("estimate"))
        .filter(F.col("estimate") >= min_sites * (1 - band))
    )
    estimates = work.stage(sketches, "estimates")
    sure = estimates.filter(F.col("estimate") > min_sites * (1 + band)).select("line")
    close = estimates.filter(F.col("estimate") <= min_sites * (1 + band)).select("line")
    near = with_maybe(rows, ["line"], membership(close, ["line"], bits), "maybe", bits).filter("maybe").select("line", "site").distinct()
    counted = near.join(close, "line", "left_semi").groupBy("line").agg(F.count(F.lit(1)).alias("sites"))
    return work.stage(sure.unionByName(counted.filter(F.col("sites") >= min_sites).select("line")), "shared")


def drop_shared_lines(docs: DataFrame, min_sites: int = MIN_SITES, band: float = BAND, bits: int = FILTER_BITS) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, clean_text."""
    work = Workings("lines")
    docs = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("site"),
        F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"),
    )
    solid = F.filter("lines", lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    rows = work.stage(docs.select("doc_id", "site", F.explode(F.array_distinct(F.transform(solid, line_hash))).alias("line")), "rows")
    shared = shared_lines(rows, min_sites, band, bits)
    hit = with_maybe(rows.select("doc_id", "line"), ["line"], membership(shared, ["line"], bits), "maybe", bits).filter("maybe")
    lost = work.stage(
        hit.join(shared, "line").groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("line").alias("lost")), "lost"
    )
    marked = with_maybe(docs.drop("site"), ["doc_id"], membership(lost, ["id"], bits), "maybe", bits)
    # The list grows with the documents: never a broadcast, at any size.
    touched = marked.filter("maybe").join(lost.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")), "left")
    left = F.filter("lines", lambda x: ~F.coalesce(F.array_contains(F.col("lost"), line_hash(x)), F.lit(False)))
    n_lines = F.size("lines").cast("long")
    cleaned = touched.select("doc_id", n_lines.alias("n_lines"), "lines", left.alias("left"))
    cleaned = cleaned.select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size("left")).alias("n_removed"), F.array_join("left", "\n").alias("clean_text")
    )
    whole = marked.filter("NOT maybe").select(
        "doc_id", n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"), F.array_join("lines", "\n").alias("clean_text")
    )
    return cleaned.unionByName(whole)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS site, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, site, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS n FROM d),
b AS (SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM l),
s AS (SELECT bare FROM b WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT site) >= 5),
k AS (SELECT b.*, s.bare IS NOT NULL AS lost FROM b LEFT JOIN s USING (bare))
SELECT any_value(d.doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT lost), '') AS clean_text
FROM k JOIN d USING (r) GROUP BY r
"""


@query("op3_line_dedup", ORACLE)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_shared_lines(table(spark, sf_dir, "documents"))
