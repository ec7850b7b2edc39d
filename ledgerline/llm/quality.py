"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a dozen transformed statistics (log rates of marks, capitals
and lines, repetition of words and word pairs, length). Rates are smoothed
towards usual prose by a few words' worth, so short texts are not extreme by
chance. Per class, sums and products of all labelled training rows are one
aggregation in Spark (no sample); the driver gets two rows of moments, shrinks
each covariance towards the pooled one and keeps its Cholesky factor. A score is
the difference of the two log densities (Mahalanobis distances by the cached
factors), plus the log ratio of the classes.

Defined cases: null text counts as empty and is scored like any other; labels that
are null are ignored; repeated rows are scored alike and count once for each pair
with a label; if a class has no training rows, every score is the share of label 1
(0.5 without labels); extra columns are ignored by ``quality_scores`` and kept by
``keep_quality``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import FILTER_BITS, crc_remainder, membership, query, table, texts, with_maybe

FEATURES = (
    "marks", "capitals", "exclamations", "bars", "doubled_words", "repeated_pairs", "word_length", "lines",
    "sentences", "distinct_words", "capital_words", "length",
)
#: Words' worth of usual prose added to every text.
PRIOR_WORDS = 20.0
#: Share of the pooled covariance in that of each class.
SHRINKAGE = 0.1
THRESHOLD = 0.7


def statistics(text: str) -> list[float]:
    data = np.frombuffer(text.encode(), np.uint8)
    count = np.bincount(data, minlength=128)
    words = text.lower().split()
    n, w, k = len(data), len(words), PRIOR_WORDS
    pairs = list(zip(words, words[1:]))
    marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum() - count[44] - count[46])
    capital_words = sum(x[:1].isupper() for x in text.split())

    def rate(seen: float, of: float, usual: float) -> float:
        return float(np.log((seen + k * usual) / (of + k)))

    return [
        rate(marks, w, 0.02),
        rate(count[65:91].sum(), n / 6, 0.15),
        rate(count[33], w, 0.01),
        rate(count[124], w, 0.01),
        float(np.sqrt((sum(a == b for a, b in pairs) + k * 0.01) / (w + k))),
        float(np.log1p(len(pairs) - len(set(pairs))) - 0.5 * np.log1p(w)),
        rate(n, w, 6.0),
        rate(count[10], w, 0.02),
        rate(count[46], w, 0.1),
        float(np.log((len(set(words)) + 5) / (w + 5))),
        rate(capital_words, w, 0.15),
        float(np.log1p(w)),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(text: pd.Series) -> pd.Series:
    return text.map(statistics)


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussian classes; ``factors`` are the inverse Cholesky factors of their covariances."""

    center: np.ndarray
    scale: np.ndarray
    means: tuple
    factors: tuple
    offsets: tuple
    share: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.center) / self.scale
        logs = [o - 0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) for m, f, o in zip(self.means, self.factors, self.offsets)]
        return logs[1] - logs[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.share)
        return squash(self.log_odds(x))


def squash(log_odds: np.ndarray) -> np.ndarray:
    """To (0, 1), keeping ranks far out, where the logistic function is 0 or 1; equal to it at 0.7."""
    at = np.log(THRESHOLD / (1 - THRESHOLD))
    soft = at * (1 - (2 * THRESHOLD - 1)) / (2 * THRESHOLD - 1)
    return 0.5 + 0.5 * log_odds / (soft + np.abs(log_odds))


def discriminant(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE) -> Discriminant:
    """From each label's (rows, sums, sums of products)."""
    total = sum(m[0] for m in moments.values())
    share = moments[1][0] / total if 1 in moments else 0.0 if total else 0.5
    if set(moments) != {0, 1}:
        return Discriminant(np.zeros(0), np.ones(0), (), (), (), share)
    center = sum(m[1] for m in moments.values()) / total
    spread = sum(np.diag(m[2]) for m in moments.values()) / total - center**2
    scale = np.sqrt(np.maximum(spread, 1e-9))
    means, covariances = [], []
    for label in (0, 1):
        n, sums, products = moments[label]
        mean = sums / n
        covariances.append((products / n - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - center) / scale)
    pooled = sum(covariances) / 2
    factors, offsets = [], []
    for label in (0, 1):
        s = (1 - shrinkage) * covariances[label] + shrinkage * pooled + 1e-3 * np.eye(len(center))
        lower = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(lower))
        offsets.append(float(np.log(moments[label][0] / total) - np.log(np.diag(lower)).sum()))
    return Discriminant(center, scale, tuple(means), tuple(factors), tuple(offsets), share)


def fit_quality(docs: DataFrame, labels: DataFrame, bits: int = FILTER_BITS) -> Discriminant:
    """Fit on all rows of ``docs`` with a label in ``labels`` that are not held out."""
    labels = labels.select("doc_id", F.col("quality").alias("label")).filter("label IN (0, 1)").filter(~held_out(F.col("doc_id")))
    known = membership(labels, ["doc_id"], bits)
    labelled = with_maybe(texts(docs), ["doc_id"], known, "maybe", bits).filter("maybe")
    x = labelled.select("doc_id", _statistics("text").alias("x")).join(labels, "doc_id")
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    rows = (
        x.select("label", *[F.col("x")[i].alias(f"x{i}") for i in range(d)])
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(f"x{i}").alias(f"s{i}") for i in range(d)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs],
        )
        .collect()
    )
    moments = {}
    for r in rows:
        products = np.zeros((d, d))
        for i, j in pairs:
            products[i, j] = products[j, i] = r[f"p{i}_{j}"]
        moments[int(r["label"])] = (r["n"], np.array([r[f"s{i}"] for i in range(d)]), products)
    return discriminant(moments)


def held_out(doc_id: Column) -> Column:
    return crc_remainder(doc_id, 4) == 2


def score_column(model: Discriminant, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(part: pd.Series) -> pd.Series:
        if not len(part):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores(np.array([statistics(t) for t in part])))

    return score(F.coalesce(text, F.lit("")))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = fit_quality(docs, labels)
    scored = texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    model = fit_quality(docs, labels)
    scored = docs.select(F.struct(*docs.columns).alias("row"), score_column(model, F.col("text")).alias("score"))
    return scored.filter(F.col("score") >= threshold).select("row.*")


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
