"""Periodic runs of words, by seeds that are extended along diagonals.

A run is a maximal stretch of words with smallest period ``q`` that holds the
period ``min_exponent`` times and ``min_words`` words. Two words ``q`` apart lie on
diagonal ``q``; a run is a stretch of equal pairs on its diagonal. Per document:

1. words become numbers, and k-grams get exact names by doubling (a 2k-gram is a
   pair of k-grams, so nothing is hashed); only grams that occur again go on;
2. the first k is the overlap that every run guarantees (16 words for three times
   and 24 words); longer lags are looked for with k-grams twice as long each time,
   k at least the lag;
3. neighbouring occurrences of a gram, at a lag of the level, are seeds. Inside a
   run a gram that is no shorter than the period recurs exactly one period later,
   so neighbours are all it takes and no pairs of farther occurrences are made;
   and the lag of neighbours is the smallest period of what grows from them;
4. a seed is extended both ways on its diagonal, unless the table of the furthest
   word covered on that diagonal says that an earlier seed has been there.

A document is never cut: the work is n log n in its words, the memory a few
numbers a word. Documents are apart from each other, so nothing is shuffled.

Defined cases: null and empty texts (and those of white space) have no words, no
runs and an empty collapsed text; very long texts are one row of one task as
everywhere; rows equal in id or text are treated each for itself; a null id is
passed through; an empty table gives no rows; other columns of ``docs`` are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import query, table, texts

MIN_WORDS = 24
MIN_EXPONENT = 3
#: Output of a worker leaves in batches of about so many bytes.
BATCH_BYTES = 8 << 20

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def words_of(text: str) -> list[bytes]:
    """Stretches of anything but the six ASCII white space characters."""
    return text.encode().split()


def _again(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense names, and which of them occur more than once."""
    _, dense, times = np.unique(names, return_inverse=True, return_counts=True)
    return dense, times[dense] > 1


def _longer(at: np.ndarray, names: np.ndarray, k: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and names of the ``to``-grams that occur again, from those of the k-grams; k < to <= 2k."""
    second = np.searchsorted(at, at + (to - k))
    held = second < len(at)
    held[held] = at[second[held]] == at[held] + (to - k)
    pairs = names[held] * (names.max(initial=0) + 1) + names[second[held]]
    dense, again = _again(pairs)
    return at[held][again], dense[again]


def _equal_ahead(ids: np.ndarray, at: int, lag: int) -> int:
    """Number of equal pairs (i, i + lag) from i = ``at`` on."""
    begin, step = at, 64
    while begin + lag < len(ids):
        stop = min(begin + step, len(ids) - lag)
        unequal = np.flatnonzero(ids[begin:stop] != ids[begin + lag : stop + lag])
        if len(unequal):
            return begin + int(unequal[0]) - at
        begin, step = stop, 2 * step
    return max(begin - at, 0)


def _equal_behind(ids: np.ndarray, at: int, lag: int) -> int:
    """Number of equal pairs (i, i + lag) before i = ``at``."""
    end, step = at, 64
    while end > 0:
        start = max(end - step, 0)
        unequal = np.flatnonzero(ids[start:end] != ids[start + lag : end + lag])
        if len(unequal):
            return at - (start + int(unequal[-1]) + 1)
        end, step = start, 2 * step
    return at


def _seeds(at: np.ndarray, names: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
    """(lag, position) where a gram recurs next at a lag in (low, high], by lag and position.

    Of seeds that follow each other on a diagonal only the first is given: they
    belong to one stretch.
    """
    order = np.argsort(names, kind="stable")
    at, names = at[order], names[order]
    lag = np.diff(at)
    fit = (names[1:] == names[:-1]) & (lag > low) & (lag <= high)
    lag, at = lag[fit], at[:-1][fit]
    order = np.lexsort((at, lag))
    lag, at = lag[order], at[order]
    first = np.ones(len(at), bool)
    first[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
    return zip(lag[first].tolist(), at[first].tolist())


def find_runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    n = len(ids)
    if n < min_words or n < min_exponent:
        return []
    k = min(max(min_words - q, (min_exponent - 1) * q) for q in range(1, min_words + 1))
    dense, again = _again(ids)
    at, names, size = np.flatnonzero(again), dense[again], 1
    while size < k and len(at):
        to = min(2 * size, k)
        at, names = _longer(at, names, size, to)
        size = to
    low, found = 0, []
    while len(at) and low < n // min_exponent:
        covered: dict[int, int] = {}
        for lag, seed in _seeds(at, names, low, k):
            if seed < covered.get(lag, 0):
                continue
            start = seed - _equal_behind(ids, seed, lag)
            end = seed + k + _equal_ahead(ids, seed + k, lag)
            covered[lag] = end
            length = end - start + lag
            if length >= max(min_words, min_exponent * lag):
                found.append((start, length, lag))
        low = k
        at, names = _longer(at, names, k, 2 * k)
        k *= 2
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run is reduced to its first period."""
    steps = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps)[:n] == 0


def _collapse(text: str, min_words: int, min_exponent: int):
    words = text_words = words_of(text)
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), np.int64, len(words))
    runs = find_runs(ids, min_words, min_exponent)
    if runs:
        text_words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))]
    return len(words), runs, b" ".join(text_words).decode()


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    doc_id, n_words, runs, collapsed = zip(*rows)
    shown = [[dict(zip(("start", "length", "period"), run)) for run in each] for each in runs]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_id, pa.int64()), pa.array(n_words, pa.int64()), pa.array(shown, pa.list_(_RUN)), pa.array(collapsed, pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def _find(min_words: int, min_exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                rows.append((doc_id.as_py(), *_collapse(text.as_py(), min_words, min_exponent)))
                size += len(rows[-1][3])
                if size > BATCH_BYTES:
                    yield _arrow(rows)
                    rows, size = [], 0
            if rows:
                yield _arrow(rows)

    return run


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period; by start and period), collapsed.

    ``collapsed`` is the words that are left when every run keeps its first period
    only, joined by one space. ``min_exponent`` is a whole number from 3 on.
    """
    if min_exponent != int(min_exponent) or min_exponent < 3 or min_words < 1:
        raise ValueError("min_exponent must be a whole number of at least 3, min_words positive")
    return texts(docs).mapInArrow(_find(int(min_words), int(min_exponent)), _SCHEMA)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts made periodic from some word on.

    With h the crc32 of the id as text and g = h div 10, texts with h mod 10 = 0
    repeat their p words from word a = g mod n on, p = 1 + (n - a) div (3 + g mod 8).
    A text whose id is null stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    marked = docs.select("doc_id", "text", h.alias("h")).filter("h % 10 = 0").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.expr("h div 10").alias("g"), words.alias("words")
    )
    placed = marked.withColumn("n", F.coalesce(F.size("words"), F.lit(0))).filter("n > 0")
    placed = placed.withColumn("a", F.expr("int(g % n)")).withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    made = F.expr("concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), int(1 + (n - a) div p))), 1, n - a))")
    periodic = placed.select("doc_id", F.array_join(made, " ").alias("text"))
    others = docs.filter(~F.coalesce((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return others.select("doc_id", "text").unionByName(periodic)


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    # Runs come by start and period, so the first of equal exponents stays.
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.reduce(
        "runs", none,
        lambda held, run: F.when(held.isNull() | (run["length"] * held["period"] > held["length"] * run["period"]), run).otherwise(held),
    )
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    shown = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return shown.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
