"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Texts are equal when they are identical without white space (space, tab to
carriage return). Three rounds, each over what the round before left:

1. rows are grouped by the length of the stripped text;
2. rows whose length repeats are grouped by (length, hash of a prefix);
3. only rows whose (length, prefix) repeats get a SHA-256 of the whole text,
   and groups of it are the groups of equal texts.

A repeated key reaches the next round as a bit in a table of fixed size
(``common.membership``), so texts are never shuffled: a collision of bits only
means that a unique text is hashed too. Keys shuffle pre-aggregated; a group
holding a third of all rows is one row after the map side.

Defined cases: null text counts as empty; all empty texts are one group; of
rows equal in id and text one stays; a null id loses every tie; extra columns
are ignored by ``exact_groups`` and kept by ``drop_exact_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import FILTER_BITS, Workings, membership, query, table, texts, with_maybe

#: White space as the contract fixes it.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 64


def stripped(text):
    return F.regexp_replace(text, WHITE_SPACE, "")


def _repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).count().filter("count > 1").select(*columns)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_bare", stripped(F.col("text"))).withColumns(
        {
            "n_points": F.length("text"),
            "bare_length": F.length("_bare"),
            "prefix_hash": F.xxhash64(F.substring("_bare", 1, PREFIX_CHARS)),
        }
    )


def exact_groups(docs: DataFrame, digest_all: bool = False, bits: int = FILTER_BITS) -> DataFrame:
    """One row per document: doc_id, n_points, text_sha256, keep_id, group_size, kept.

    ``text_sha256`` is null for rows that an earlier round proved unique, unless
    ``digest_all`` asks for every digest. ``kept`` marks the row that stays: most
    code points, then the smallest doc_id.
    """
    work = Workings("exact-dedup")
    docs = texts(docs)
    narrow = work.stage(_keyed(docs).select("bare_length", "prefix_hash"), "keys")

    lengths = membership(_repeated(narrow, ["bare_length"]), ["bare_length"], bits)
    second = with_maybe(narrow, ["bare_length"], lengths, "maybe", bits).filter("maybe")
    prefixes = work.stage(
        membership(_repeated(second, ["bare_length", "prefix_hash"]), ["bare_length", "prefix_hash"], bits), "prefixes"
    )
    third = with_maybe(_keyed(docs), ["bare_length", "prefix_hash"], prefixes, "survives", bits)
    digest = F.sha2("_bare", 256)
    rows = work.stage(
        third.select(
            "doc_id", F.col("n_points").cast("long").alias("n_points"), "bare_length", "prefix_hash", "survives",
            (digest if digest_all else F.when(F.col("survives"), digest)).alias("text_sha256"),
        ),
        "rows",
    )
    work.drop(narrow, prefixes)

    key = ["bare_length", "prefix_hash", "text_sha256"]
    # Rows equal in id and text count once here and are told apart at the end.
    distinct = work.stage(
        rows.filter("survives").groupBy(*key, "doc_id", "n_points").agg(F.count(F.lit(1)).alias("copies")), "distinct"
    )
    # ~doc_id reverses the order of ids without overflow.
    groups = work.stage(
        distinct.groupBy(*key)
        .agg(
            F.sum("copies").alias("group_size"),
            F.max(F.struct("n_points", F.bitwise_not(F.col("doc_id")).alias("back"))).alias("best"),
        )
        .select(
            *key, "group_size", F.bitwise_not(F.col("best.back")).alias("keep_id"),
            F.col("best.n_points").alias("keep_points"),
        ),
        "groups",
    )
    grouped = (
        distinct.join(groups, key)
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .withColumn(
            "kept",
            F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points")) & (F.col("copy") == 1),
        )
        .select("doc_id", "n_points", "text_sha256", "keep_id", "group_size", "kept")
    )
    alone = rows.filter(~F.col("survives")).select(
        "doc_id", "n_points", "text_sha256", F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
    )
    return grouped.unionByName(alone)


def _same(doc_id, points, digest):
    """What rows equal in id and text share; a null id is left out, so it is equal to itself only."""
    return F.concat_ws(":", doc_id, points, digest).alias("same")


def drop_exact_duplicates(docs: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows whose id is surely not in a group pass as they are; the others are
    matched with the decisions, so texts of unique documents aren't shuffled.
    Of rows equal in id and text one is left before that, by the key that the
    match is on: the texts of suspects are read and shuffled once.
    """
    work = Workings("exact-dedup")
    verdicts = work.stage(exact_groups(docs, bits=bits).filter("group_size > 1"), "verdicts")
    grouped = membership(verdicts.select("doc_id"), ["doc_id"], bits)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", text.alias("text"))
    marked = with_maybe(rows, ["doc_id"], grouped, "maybe", bits)
    digest = F.sha2(stripped(F.col("text")), 256)
    suspects = marked.filter("maybe").select("row", _same(F.col("doc_id"), F.length("text"), digest)).dropDuplicates(["same"])
    known = verdicts.groupBy(_same(F.col("doc_id"), F.col("n_points"), F.col("text_sha256"))).agg(F.max("kept").alias("kept"))
    stay = suspects.join(known, "same", "left").filter("coalesce(kept, true)")
    return marked.filter("NOT maybe").select("row.*").unionByName(stay.select("row.*"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS (SELECT doc_id, length(t) AS n, sha256(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM d)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
       text_sha256
FROM k
"""


@query("op2_exact_dedup", ORACLE)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"), digest_all=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
