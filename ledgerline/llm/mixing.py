"""Mix sources to target weights by hash-random order and distributed prefix sums.

Every row gets a random key from a hash of its id. Within a source, rows are
range-partitioned by that key (a bucket is a prefix of the hash, about
``ROWS_PER_BUCKET`` rows wide, so a source with a third of all rows is as many
buckets as it needs). Sums of words per bucket give prefix sums over buckets in
two levels, a window inside each bucket adds the rows before, and a row is taken
whole, in part or not at all as its range of words lies before, across or beyond
the source's budget. A target above the source's size repeats it for whole
epochs first.

Defined cases: null text has size 0; a null source is a source of its own, last
in order; an empty text is taken 0 times; rows equal in id are ordered by size,
so repeated rows are exchangeable and reruns agree; an empty table gives no rows;
a very long text is one row, cut like any other; extra columns, whatever their
names, are ignored by the mix and kept as they are where rows are repeated.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import Workings, membership, query, table, with_maybe

#: Words as the contract fixes them.
WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 2000
MOST_EPOCHS = 3
SEED = "mix:"


def source_targets(sizes: DataFrame, weights=(1, 2, 3), most: int = MOST_EPOCHS) -> DataFrame:
    """Targets per source from (source, source_size): one row per source.

    The total of all sizes is shared by weight; a source stops at ``most`` times
    its size and the rest is shared again. Sources in order of size per weight
    are full one after the other, so one ordered pass finds who is full. It runs
    over the table of sources (one row each), not over documents.
    """
    everyone = W.partitionBy()
    by_name = everyone.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, len(weights)) + 1).cast("long")
    ).withColumn("cap", F.lit(most).cast("long") * F.col("source_size"))
    fullest = everyone.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    here = ranked.withColumns(
        {
            "total": F.sum("source_size").over(everyone),
            "cap_before": F.coalesce(F.sum("cap").over(fullest.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "weight_left": F.sum("weight").over(fullest.rowsBetween(0, W.unboundedFollowing)),
        }
    ).withColumn(
        "full",
        F.col("cap").cast("double") * F.col("weight_left")
        <= F.col("weight").cast("double") * (F.col("total") - F.col("cap_before")),
    )
    shared = here.withColumns(
        {
            "cap_full": F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everyone), F.lit(0)),
            "weight_open": F.sum(F.when(~F.col("full"), F.col("weight"))).over(everyone),
        }
    )
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.col("weight").cast("double") * (F.col("total") - F.col("cap_full")).cast("double") / F.col("weight_open").cast("double")
    )
    return shared.select("source", "source_size", target.alias("target"))


def _name(source):
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _key(doc_id):
    return F.md5(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit(""))))


def mix_sources(docs: DataFrame, weights=(1, 2, 3), most: int = MOST_EPOCHS, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken."""
    docs = docs.select("doc_id", "source", "text")
    placed = _placed(docs.withColumn("key", _key(F.col("doc_id"))), weights, most, rows_per_bucket)
    return placed.select("doc_id", "source", "size", "source_size", "target", "taken")


def _placed(docs: DataFrame, weights, most: int, rows_per_bucket: int) -> DataFrame:
    work = Workings("mixing")
    rows = work.stage(
        docs.select(
            "doc_id", "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            "key",
        ),
        "rows",
    )
    digits = max(1, math.ceil(math.log(max(1, rows.count() / rows_per_bucket), 16)))
    coarse = max(1, digits // 2)
    named = rows.withColumns({"name": _name(F.col("source")), "bucket": F.substring("key", 1, digits)})
    buckets = work.stage(
        named.groupBy("name", "source", "bucket").agg(F.sum("size").alias("words")).withColumn("upper", F.substring("bucket", 1, coarse)),
        "buckets",
    )
    upper = buckets.groupBy("name", "upper").agg(F.sum("words").alias("words"))
    upper = upper.select(
        "name", "upper",
        F.coalesce(F.sum("words").over(W.partitionBy("name").orderBy("upper").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("upper_before"),
    )
    targets = work.stage(
        source_targets(buckets.groupBy("name", "source").agg(F.sum("words").alias("source_size")), weights, most), "targets"
    ).withColumn("name", _name(F.col("source")))
    whole = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.select(
        "name", "source_size", "target", epochs.alias("epochs"), (whole - epochs * F.col("source_size")).alias("rest")
    )
    starts = work.stage(
        buckets.withColumn(
            "inner_before",
            F.coalesce(F.sum("words").over(W.partitionBy("name", "upper").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        )
        .join(upper, ["name", "upper"])
        .join(targets, "name")
        .select("name", "bucket", "source_size", "target", "epochs", "rest", (F.col("upper_before") + F.col("inner_before")).alias("start")),
        "starts",
    )
    in_bucket = W.partitionBy("name", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = named.withColumn("within", F.coalesce(F.sum("size").over(in_bucket), F.lit(0))).join(starts, ["name", "bucket"])
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start") - F.col("within")))
    return placed.select(
        "doc_id", "source", "name", "key", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")
    )


def repeat_to_mix(docs: DataFrame, weights=(1, 2, 3), most: int = MOST_EPOCHS, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Rows are whole: the one that a budget cuts counts if at least half of it is
    taken. Rows without words, which weigh nothing, stay out. In the hash order a
    source is taken once more up to one key, so a row needs only its source's
    epochs and that key, and texts are not shuffled while that table (a row for
    each source) is small enough for Spark to broadcast.

    Rows that share an id within a source (a null one too) get keys of their own,
    from all their columns: they spread over the order like any others, and the cut
    falls between them. Only such rows are written once more, to be numbered: equal
    rows are told apart by that number alone, so whichever is taken is the same row.
    """
    work = Workings("mixing")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", "text", _name(F.col("source")).alias("name"), _key(F.col("doc_id")).alias("key"))
    shared = work.stage(rows.groupBy("name", "key").count().filter("count > 1").select("name", "key"), "shared")
    marked = with_maybe(rows, ["name", "key"], membership(shared, ["name", "key"]), "maybe")
    maybe = marked.filter("maybe").drop("maybe").join(shared.withColumn("again", F.lit(True)), ["name", "key"], "left")
    own = F.concat(F.md5(F.concat("key", F.to_json("row"))), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    maybe = work.stage(maybe.withColumn("key", F.when(F.col("again"), own).otherwise(F.col("key"))).drop("again"), "numbered")
    rows = marked.filter(~F.col("maybe")).drop("maybe").unionByName(maybe)
    placed = _placed(rows, weights, most, rows_per_bucket).filter("size > 0")
    once_more = F.when(2 * (F.col("taken") - F.col("epochs") * F.col("size")) >= F.col("size"), F.col("key"))
    cuts = work.stage(placed.groupBy("name").agg(F.first("epochs").alias("epochs"), F.max(once_more).alias("cut")), "cuts")
    times = (F.col("epochs") + F.coalesce(F.col("key") <= F.col("cut"), F.lit(False)).cast("long")).cast("int")
    worded = rows.filter(F.col("text").rlike(WORD)).select("row", "name", "key")
    copies = worded.join(cuts, "name").select("row", F.explode(F.array_repeat(F.lit(0), times)))
    return copies.select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS BIGINT) AS w
  FROM d GROUP BY source
),
c AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM s
),
f AS (SELECT *, CAST(cap AS DOUBLE) * w_left <= CAST(w AS DOUBLE) * (total - cap_before) AS is_full FROM c),
g AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN CAST(cap AS DOUBLE)
              ELSE CAST(w AS DOUBLE)
                   * CAST(total - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0) AS DOUBLE)
                   / CAST(sum(CASE WHEN NOT is_full THEN w END) OVER () AS DOUBLE) END AS target
  FROM f
),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM g
),
p AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_it
  FROM d
)
SELECT p.doc_id, p.size, e.source_size, e.target,
       CAST(e.epochs * p.size
         + greatest(0, least(p.size, CAST(round(e.target) AS BIGINT) - e.epochs * e.source_size - p.before_it)) AS BIGINT) AS taken
FROM p JOIN e ON p.source IS NOT DISTINCT FROM e.source
"""


@query("op6_mix_sources", ORACLE)
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
