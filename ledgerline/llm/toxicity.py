"""Toxic spans and document scores from a linear-chain conditional random field.

The chain tags each word clean (0) or toxic (1). Its features are whole words and
word beginnings, so inflected forms of a stem share weight. Training, in steps:

1. Over all labelled training documents Spark counts in how many toxic and how
   many other documents each word occurs, sums that for beginnings and keeps the
   features that surely lean to toxic documents (``FEATURES`` at most).
2. A word of a toxic document that has such a feature is labelled toxic, every
   other word clean. The chain is fitted to these labelled words of a bounded
   sample: at most ``SAMPLE`` documents of each class, first in order of a hash
   of their id.
3. Forward-backward gives each word's marginal. A logistic function of their
   largest log odds, their sum and their density, fitted on the same sample with
   the classes weighted as they occur, gives a document's score.

Scoring tags every word of every text.

Defined cases: null text counts as empty; texts without words are scored like any
text without a toxic word; labels that are null are ignored; repeated rows score
alike; if a class has no training rows, every score is the share of label 1 (0
without labels); extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import FILTER_BITS, Workings, crc_remainder, membership, query, table, texts, with_maybe

WORD = re.compile(r"\w+")
#: Lengths of the beginnings that are features.
BEGINNINGS = (3, 4, 5, 6, 7)
FEATURES = 2048
SAMPLE = 2000
#: Words to a training sequence.
WINDOW = 100
#: Different words that a task counts before it hands them on.
MOST_WORDS = 500_000
LEAST_SEEN = 4
LEAST_LEAN = 1.5


def features_of(word: str) -> list[str]:
    """The word itself and its proper beginnings (marked by a final '*')."""
    word = word.lower()
    return [word, *(word[:n] + "*" for n in BEGINNINGS if n < len(word))]


@dataclass
class Chain:
    """weights by feature; emission of state 1 is bias plus weights, of state 0 nothing."""

    weights: dict[str, float]
    bias: float = 0.0
    moves: tuple = ((0.0, 0.0), (0.0, 0.0))
    document: tuple = (0.0, 0.0, 0.0, 0.0)
    share: float | None = None
    _seen: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_seen": {}}

    def emission(self, word: str) -> float | None:
        """Summed weights of the word, None if it has no feature."""
        try:
            return self._seen[word]
        except KeyError:
            found = [self.weights[f] for f in features_of(word) if f in self.weights]
            if len(self._seen) > 500_000:  # a cache, only of memory
                self._seen.clear()
            self._seen[word] = made = sum(found) if found else None
            return made

    def marginals(self, emissions: list[float | None]) -> np.ndarray:
        """Probability of state 1 for each word, by forward-backward on the odds of the states."""
        (m00, m01), (m10, m11) = np.exp(self.moves).tolist()
        plain = float(np.exp(self.bias))
        odds = [plain if e is None else float(np.exp(min(self.bias + e, 60.0))) for e in emissions]
        n = len(odds)
        ahead, back = [0.0] * n, [1.0] * n
        r = 0.0
        for t in range(n):
            r = odds[t] if t == 0 else odds[t] * (m01 + r * m11) / (m00 + r * m10)
            ahead[t] = r
        b = 1.0
        for t in range(n - 2, -1, -1):
            b *= odds[t + 1]
            b = (m10 + m11 * b) / (m00 + m01 * b)
            back[t] = b
        both = np.array(ahead) * np.array(back)
        return both / (1 + both)

    def summary(self, marginals: np.ndarray) -> tuple[float, float, float]:
        top = float(np.clip(marginals.max(initial=0.0), 1e-5, 1 - 1e-5))
        total = float(marginals.sum())
        return float(np.log(top / (1 - top))), float(np.log1p(total)), float(np.log((total + 0.2) / (len(marginals) + 20)))

    def score(self, summary: tuple[float, float, float]) -> float:
        if self.share is not None:
            return self.share
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.document, (1.0, *summary)), -36, 36))))

    def tag(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """A document's score and its toxic words (start, end, marginal), ends exclusive."""
        words = WORD.findall(text)
        emissions = [self.emission(w) for w in words]
        if all(e is None for e in emissions):
            return self.score(self.summary(self._plain(len(words)))), []
        p = self.marginals(emissions)
        at = np.flatnonzero(p >= 0.5).tolist()
        places = [m.span() for m in WORD.finditer(text)] if at else []
        return self.score(self.summary(p)), [(*places[t], float(p[t])) for t in at]

    def _plain(self, n: int) -> np.ndarray:
        """Marginals of words without features; far from both ends they are all alike."""
        m = self.marginals([None] * min(n, 400))
        return m if n <= 400 else np.concatenate((m[:200], np.full(n - 400, m[200]), m[200:]))


def fit_chain(sequences: list[tuple[list[list[int]], list[int]]], names: list[str], steps: int = 120, decay: float = 1e-3) -> Chain:
    """Fit to sequences of (feature numbers of each word, label of each word), by Adam on the exact likelihood."""
    n, longest = len(sequences), max(len(s[1]) for s in sequences)
    y = np.zeros((n, longest), np.int8)
    there = np.zeros((n, longest), bool)
    place, number = [], []
    for i, (words, labels) in enumerate(sequences):
        y[i, : len(labels)] = labels
        there[i, : len(labels)] = True
        for t, found in enumerate(words):
            place += [i * longest + t] * len(found)
            number += found
    place, number = np.array(place, np.int64), np.array(number, np.int64)
    follows = there[:, 1:]
    seen = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & follows).sum() for b in (0, 1)] for a in (0, 1)], float)
    seen_w = np.bincount(number, y.ravel()[place], len(names)) if len(number) else np.zeros(len(names))
    seen_b = float(y[there].sum())
    size = len(names) + 5
    theta, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    theta[len(names)] = -3.0
    words = max(1, int(there.sum()))
    for step in range(1, steps + 1):
        w, bias, moves = theta[: len(names)], theta[len(names)], theta[len(names) + 1 :].reshape(2, 2)
        emit = (np.bincount(place, w[number], n * longest) if len(number) else np.zeros(n * longest)).reshape(n, longest) + bias
        odds, m = np.exp(np.minimum(emit, 60.0)), np.exp(moves)
        ahead, back = np.zeros((n, longest)), np.ones((n, longest))
        ahead[:, 0] = odds[:, 0]
        for t in range(1, longest):
            ahead[:, t] = odds[:, t] * (m[0, 1] + ahead[:, t - 1] * m[1, 1]) / (m[0, 0] + ahead[:, t - 1] * m[1, 0])
        for t in range(longest - 2, -1, -1):
            b = odds[:, t + 1] * back[:, t + 1]
            back[:, t] = np.where(there[:, t + 1], (m[1, 0] + m[1, 1] * b) / (m[0, 0] + m[0, 1] * b), 1.0)
        p = ahead * back / (1 + ahead * back)
        after = odds[:, 1:] * back[:, 1:]
        pair = np.stack([m[0, 0] * np.ones_like(after), m[0, 1] * after, m[1, 0] * ahead[:, :-1], m[1, 1] * ahead[:, :-1] * after])
        pair = (pair / pair.sum(axis=0) * follows).sum(axis=(1, 2)).reshape(2, 2)
        gradient = np.concatenate(
            (
                seen_w - (np.bincount(number, p.ravel()[place], len(names)) if len(number) else 0.0),
                [seen_b - p[there].sum()],
                (seen - pair).ravel(),
            )
        ) / words - decay * theta / 100
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta = theta + 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-12) * (1 - step / (steps + 1))
    moves = theta[len(names) + 1 :].reshape(2, 2)
    return Chain(dict(zip(names, theta[: len(names)].tolist())), float(theta[len(names)]), tuple(map(tuple, moves.tolist())))


def fit_document(summaries: np.ndarray, labels: np.ndarray, weights: np.ndarray, steps: int = 60) -> tuple:
    """Weighted ridge logistic regression by Newton steps."""
    x = np.column_stack((np.ones(len(summaries)), summaries))
    theta, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-4] * (x.shape[1] - 1)) * weights.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -36, 36)))
        slope = x.T @ (weights * (labels - p)) - ridge @ theta
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge
        theta = theta + np.linalg.solve(curve, slope)
    return tuple(theta.tolist())


def held_out(doc_id: Column) -> Column:
    return crc_remainder(doc_id, 5) == 0


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word with the number of toxic and other documents that have it, summed as far as memory allows."""
    seen = (Counter(), Counter())

    def summed() -> pa.RecordBatch:
        words = list(seen[0].keys() | seen[1].keys())
        made = {"word": pa.array(words, pa.string())}
        for name, counts in zip(("clean", "toxic"), seen):
            made[name] = pa.array([counts[w] for w in words], pa.int64())
            counts.clear()
        return pa.RecordBatch.from_pydict(made)

    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
            seen[label].update(set(WORD.findall(text.lower())))
            if len(seen[0]) + len(seen[1]) > MOST_WORDS:
                yield summed()
    yield summed()


def leaning_features(labelled: DataFrame, numbers: dict[int, int], most: int = FEATURES) -> list[str]:
    """Words and beginnings that toxic documents surely have more often; ``numbers``: documents by label."""
    words = labelled.select("label", "text").mapInArrow(_count_words, "word string, clean long, toxic long")
    words = words.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    names = F.array(F.col("word"), *[F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in BEGINNINGS])
    counts = (
        words.select(F.explode(F.array_compact(names)).alias("name"), "clean", "toxic")
        .groupBy("name")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("toxic") >= LEAST_SEEN)
    )
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    lean = F.log(toxic / (numbers[1] + 1)) - F.log(clean / (numbers[0] + 1)) - 2 * F.sqrt(1 / toxic + 1 / clean)
    best = counts.withColumn("lean", lean).filter(F.col("lean") >= LEAST_LEAN).orderBy(F.desc("lean"), "name").limit(most)
    return [r["name"] for r in best.collect()]


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = FILTER_BITS) -> Chain:
    """The chain, from the labelled rows of ``docs`` that are not held out."""
    work = Workings("toxicity")
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter("label IN (0, 1)").filter(~held_out(F.col("doc_id")))
    known = membership(labels, ["doc_id"], bits)
    # Labels grow with the documents: never a broadcast, at any size.
    maybe = with_maybe(texts(docs), ["doc_id"], known, "maybe", bits).filter("maybe").drop("maybe")
    labelled = work.stage(maybe.join(labels.hint("merge"), "doc_id"), "labelled")
    numbers = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if set(numbers) != {0, 1}:
        work.drop(labelled)
        return Chain({}, share=1.0 if 1 in numbers else 0.0)
    names = leaning_features(labelled, numbers)
    known_features = {f: k for k, f in enumerate(names)}

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each sampled document the number of words and those with features."""
        for batch in batches:
            out = {"label": [], "words": [], "at": [], "found": []}
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                words = WORD.findall(text)
                hits = [(t, k) for t, w in enumerate(words) for f in features_of(w) if (k := known_features.get(f)) is not None]
                out["label"].append(label)
                out["words"].append(len(words))
                out["at"].append([t for t, _ in hits])
                out["found"].append([k for _, k in hits])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["label"], pa.int32()), pa.array(out["words"], pa.int64()), pa.array(out["at"], pa.list_(pa.int32())), pa.array(out["found"], pa.list_(pa.int32()))],
                names=list(out),
            )

    documents = []
    for label in (0, 1):
        # The ids come first, so that only the sampled texts are read again.
        chosen = labelled.filter(F.col("label") == label).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        ids = [r["doc_id"] for r in chosen.collect()]
        part = labelled.filter((F.col("label") == label) & F.col("doc_id").isin(ids))
        documents += part.select("label", "text").mapInArrow(reduce, "label int, words long, at array<int>, found array<int>").collect()
    work.drop(labelled)
    documents.sort(key=lambda r: (r["label"], r["words"], r["at"], r["found"]))

    sequences, per_document = [], []
    for r in documents:
        words: dict[int, list[int]] = {}
        for t, k in zip(r["at"], r["found"]):
            words.setdefault(t, []).append(k)
        per_document.append(words)
        for begin in range(0, r["words"], WINDOW):
            span = range(begin, min(begin + WINDOW, r["words"]))
            found = [words.get(t, []) for t in span]
            # Windows without a feature differ only in length: they count once for each document.
            if any(found) or begin == 0:
                sequences.append((found, [int(bool(f) and r["label"] == 1) for f in found]))
    if not sequences or not names:
        return Chain({}, share=numbers[1] / (numbers[0] + numbers[1]))
    chain = fit_chain(sequences, names)
    summaries = []
    for r, words in zip(documents, per_document):
        weight = {t: sum(chain.weights[names[k]] for k in found) for t, found in words.items()}
        summaries.append(chain.summary(chain.marginals([weight.get(t) for t in range(r["words"])]) if weight else chain._plain(r["words"])))
    y = np.array([r["label"] for r in documents], float)
    drawn = Counter(y.tolist())
    weights = np.array([numbers[int(v)] / drawn[v] for v in y])
    chain.document = fit_document(np.array(summaries), y, weights)
    return chain


def toxic_spans(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, spans (start, end, marginal of each toxic word)."""
    chain = fit_toxicity(docs, labels, sample)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tagged = [chain.tag(t) for t in batch.column("text").to_pylist()]
            spans = [[dict(zip(("start", "end", "marginal"), s)) for s in found] for _, found in tagged]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([s for s, _ in tagged], pa.float64()), pa.array(spans, pa.list_(span))],
                names=["doc_id", "held_out", "score", "spans"],
            )

    rows = texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = rows.mapInArrow(
        run, "doc_id long, held_out boolean, score double, spans array<struct<start: int, end: int, marginal: double>>"
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = toxic_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return spans.select("doc_id", "held_out", "score", "predicted", "spans")
