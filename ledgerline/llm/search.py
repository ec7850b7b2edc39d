"""Ranked lexical search with hashed max-sketches.

``build_index`` stores one row per document: its length, its terms with their
counts, and a sketch. A sketch has ``coords`` coordinates; a term falls on the one
its hash names, and a coordinate keeps the largest count that fell on it. A
document's impact of a term grows with the count, so the impact of a coordinate's
count is the coordinatewise maximum of impacts: an upper bound for every term that
falls there, whatever the collection's statistics are later.

``search`` looks a block of queries up at once. For a chunk of documents the
bounds are one product of matrices (impacts by coordinate, weights by coordinate
and query). Then, query by query, documents are scored exactly in descending
order of their bounds until the next bound is below the threshold, the k-th best
exact score the task has seen. Only a task's k best rows for a query leave it, and
they are ranked in two steps. A bound is never below its score, so the result is
exact; ``coords`` only decides how many documents are scored in vain.

Queries go in blocks of about ``ITEMS_PER_BLOCK`` queries and ``TERMS_PER_BLOCK``
terms (a longer query is a block of its own): that is what is sent to each task,
and each block reads the index once. Document frequencies are counted by Spark,
for the terms of the queries only.

Defined cases: null and empty texts have no terms: such documents are not counted
and never found, such queries find nothing; very long texts are one row of one
task; rows equal in doc_id are documents of their own, repeated queries are
answered each; equal scores rank by doc_id, null ids last; an empty table (or one
without any term) gives no rows; other columns of both tables are ignored, whatever
their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import Workings, membership, query, table, texts, with_maybe

#: Coordinates of a sketch, a power of two of at most 2^16.
COORDS = 4096
TOP = 50
ITEMS_PER_BLOCK, TERMS_PER_BLOCK = 256, 50_000
#: Documents of a chunk: a matrix of CHUNK x COORDS doubles.
CHUNK = 256
#: Groups in which the rows of one query are ranked before they meet.
SALTS = 64

#: Letters A to Z in lower case, other ASCII but digits and letters as blanks; bytes from 128 on are terms.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_INDEX_SCHEMA = "doc_id long, n long, coords binary, peaks binary, terms string, counts binary"


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def sketch(terms: list[bytes], counts: np.ndarray, coords: int) -> tuple[np.ndarray, np.ndarray]:
    """The coordinates that hold anything, and the largest count on each."""
    at = np.fromiter(map(crc32, terms), np.uint32, len(terms)) & np.uint32(coords - 1)
    peaks = np.zeros(coords, np.uint32)
    np.maximum.at(peaks, at, counts)
    held = np.flatnonzero(peaks)
    return held.astype("<u2"), peaks[held].astype("<u4")


def _describe(coords: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                words = terms_of(text)
                held = Counter(words)
                terms, counts = list(held), np.fromiter(held.values(), np.uint32, len(held))
                at, peaks = sketch(terms, counts, coords)
                rows.append((len(words), at.tobytes(), peaks.tobytes(), b" ".join(terms).decode(), counts.astype("<u4").tobytes()))
            n, at, peaks, terms, counts = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(at, pa.binary()), pa.array(peaks, pa.binary()),
                    pa.array(terms, pa.string()), pa.array(counts, pa.binary()),
                ],
                names=["doc_id", "n", "coords", "peaks", "terms", "counts"],
            )

    return run


def build_index(docs: DataFrame, coords: int = COORDS) -> DataFrame:
    """The index of ``docs``, one stored row per document: doc_id, n, coords, peaks, terms, counts."""
    if coords < 1 or coords > 1 << 16 or coords & (coords - 1):
        raise ValueError("coords must be a power of two up to 65536")
    return Workings("search").stage(texts(docs).mapInArrow(_describe(coords), _INDEX_SCHEMA), "index")


def impacts(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


class _Block:
    """A block of queries in a task: weights by coordinate, terms by query, best rows so far."""

    def __init__(self, queries: list[tuple[int, list[bytes], list[int]]], coords: int, k: int):
        self.keys = [key for key, _, _ in queries]
        self.terms = [list(zip(terms, weights)) for _, terms, weights in queries]
        at = [np.fromiter(map(crc32, terms), np.uint32, len(terms)) & np.uint32(coords - 1) for _, terms, _ in queries]
        used = np.unique(np.concatenate(at)) if at else np.zeros(0, np.uint32)
        self.column = np.full(coords, -1, np.int64)
        self.column[used] = np.arange(len(used))
        self.weights = np.zeros((len(used), len(queries)))
        for q, (_, _, weights) in enumerate(queries):
            np.add.at(self.weights[:, q], self.column[at[q]], weights)
        self.k = k
        self.best: list[list] = [[] for _ in queries]
        self.threshold = np.zeros(len(queries))
        self.scored = 0

    def bounds(self, m: np.ndarray, coords: list[bytes], peaks: list[bytes]) -> np.ndarray:
        """Upper bounds of the scores, documents by queries."""
        row = np.repeat(np.arange(len(m)), [len(c) // 2 for c in coords])
        column = self.column[np.frombuffer(b"".join(coords), "<u2")]
        peak = np.frombuffer(b"".join(peaks), "<u4").astype(np.int64)
        used = column >= 0
        row, column, peak = row[used], column[used], peak[used]
        dense = np.zeros((len(m), len(self.weights)))
        dense[row, column] = impacts(peak, m[row])
        # Sums beyond 2^53 may be rounded down: the factor makes up for it.
        return dense @ self.weights * (1 + 1e-9)

    def see(self, doc_ids: list, m: np.ndarray, bounds: np.ndarray, terms: list[str], counts: list[bytes]) -> None:
        """Score the documents of a chunk that can be among the best."""
        held: dict[int, dict] = {}
        hopeful = (bounds > 0) & (bounds >= self.threshold)
        for q in np.flatnonzero(hopeful.any(axis=0)).tolist():
            rows = np.flatnonzero(hopeful[:, q])
            best, mine = self.best[q], self.terms[q]
            for r in rows[np.argsort(-bounds[rows, q], kind="stable")].tolist():
                if len(best) == self.k and bounds[r, q] < best[0][0]:
                    break
                if r not in held:
                    held[r] = dict(zip(terms[r].encode().split(b" "), np.frombuffer(counts[r], "<u4").tolist()))
                tf_of, mr = held[r], 20 * int(m[r])
                score = sum(w * (1_000_000_000 * tf_of[t] // (1000 * tf_of[t] + mr)) for t, w in mine if t in tf_of)
                self.scored += 1
                if score > 0:
                    entry = (score, -math.inf if doc_ids[r] is None else -doc_ids[r])
                    if len(best) < self.k:
                        heapq.heappush(best, entry)
                    else:
                        heapq.heappushpop(best, entry)
            if len(best) == self.k:
                self.threshold[q] = best[0][0]

    def rows(self) -> pa.RecordBatch:
        keys, ids, scores = [], [], []
        for key, best in zip(self.keys, self.best):
            for score, negative in best:
                keys.append(key)
                ids.append(None if negative == -math.inf else -negative)
                scores.append(score)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"]
        )


def _scan(queries: list[tuple[int, list[bytes], list[int]]], documents: int, words: int, coords: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(queries, coords, k)
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK):
                part = batch.slice(begin, CHUNK)
                lists = {name: part.column(name).to_pylist() for name in part.schema.names}
                m = 50 + (50 * np.array(lists["n"], np.int64) * documents) // words
                bounds = block.bounds(m, lists["coords"], lists["peaks"])
                block.see(lists["doc_id"], m, bounds, lists["terms"], lists["counts"])
        yield block.rows()

    return run


def _queries(work: Workings, items: DataFrame) -> DataFrame:
    """(item, item_id, term), the terms of each query once; ``item`` tells rows apart."""
    lowered = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = work.stage(
        items.select("item_id", F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("terms"))
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    return rows.select("item", "item_id", F.explode("terms").alias("term"))


def _frequencies(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df) of the given terms; other terms are left out before any shuffle."""
    held = index.filter("n > 0").select(F.explode(F.split("terms", " ")).alias("term"))
    wanted = with_maybe(held, ["term"], membership(terms, ["term"]), "maybe").filter("maybe")
    return wanted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def search(index: DataFrame, items: DataFrame, k: int = TOP, coords: int = COORDS) -> DataFrame:
    """The k best documents of every query: item (a number for the query's row), item_id, rank, doc_id, score.

    ``index`` comes from ``build_index`` with the same ``coords``; ``items`` has
    item_id and text.
    """
    spark = index.sparkSession
    work = Workings("search")
    documents, words = index.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked = _queries(work, items)
    frequencies = _frequencies(index, asked.select("term").distinct())
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("long")
    # Terms that no document holds add nothing to any score.
    weighted = work.stage(asked.join(frequencies, "term").select("item", "term", weight.alias("w")), "weights")
    n_items, n_terms = weighted.agg(F.count_distinct("item"), F.count(F.lit(1))).first()
    blocks = max(1, math.ceil(n_items / ITEMS_PER_BLOCK), math.ceil(n_terms / TERMS_PER_BLOCK))
    best = None
    for block in range(blocks if words else 0):
        lists = (
            weighted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).groupBy("item")
            .agg(F.collect_list("term").alias("terms"), F.collect_list("w").alias("weights")).collect()
        )
        if not lists:
            continue
        queries = [(r["item"], [t.encode() for t in r["terms"]], list(r["weights"])) for r in lists]
        found = index.filter("n > 0").mapInArrow(_scan(queries, documents, words, coords, k), "item long, doc_id long, score long")
        best = found if best is None else best.unionByName(found)
    if best is None:
        best = spark.createDataFrame([], "item long, doc_id long, score long")
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    salted = best.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(W.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id").distinct(), "item").select("item", "item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
),
s AS (SELECT count(*) AS big_n, CAST(sum(len(t)) AS BIGINT) AS big_l FROM d WHERE len(t) > 0),
q AS (
  SELECT i, item_id, unnest(list_distinct(t)) AS term
  FROM (SELECT row_number() OVER () AS i, item_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark)
),
h AS (
  SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3, 4
),
w AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM h GROUP BY term), s
),
p AS (
  SELECT i, item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM q JOIN h USING (term) JOIN w USING (term), s GROUP BY 1, 2, 3, 4
),
k AS (
  SELECT i, item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM p WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""


@query("op11_ranked_search", ORACLE)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents"))
    return search(index, table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")
