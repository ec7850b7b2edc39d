"""Licence scan: a trained paragraph classifier, confirmed by templates.

A paragraph is a line, or neighbouring lines of a block (lines between lines without
words) that only together hold a notice: of those the smallest run is a finding,
numbered by its first line. Comment marks at the start of lines are dropped.
A paragraph is scored by a sparse logistic regression over hashed word
unigrams and bigrams, one class for each licence family and one for unknown. It
is trained on the driver from the template sentences below, varied and embedded
in prose, against a bounded sample of the corpus's own paragraphs (``SAMPLE``);
an L1 penalty leaves weights on few n-grams. Part of the training rows is held out
to calibrate: a temperature for the probabilities, and the least probability at
which at most ``FALSE_SHARE`` of unknown paragraphs would pass. A prediction counts if
a template of its family is contained in the paragraph (share of the template's
bigrams, with version numbers or without). So the templates say what can be found,
and the classifier which family it is and what is no notice.

Runs of lines are tried from each line that has a bigram of a template to each such
line after it, as long as the whole lines between hold at most ``REACH`` words (twice
the longest template); documents that hold no template at all are left out before.

Scoring uses DataFrame functions only: words, hashes and weights are array
expressions, and the weights are one literal of fixed size (2^DIM_BITS buckets).
Features are hashed by the same expressions in training.

Defined cases: null text counts as empty; documents without a licence have an empty
list; paragraphs are numbered from 0, blank ones too; rows equal in id share their
findings; without any paragraphs to sample the templates alone are trained on;
very long texts are read whole, line by line, and only lines of more than
``SAMPLE_CHARS`` characters aren't drawn for training; an empty table gives no rows;
extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Workings, query, table

# Sentences of public licence notices.
TEMPLATES = {
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc_by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc_by_nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc_by_nc_nd": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-NC-ND 4.0.",
    ),
    "cc_by_nc_sa": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ),
    "cc_by_nd": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-ND 4.0.",
    ),
    "cc_by_sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Licensed under the ISC license.",
        "SPDX-License-Identifier: ISC",
    ),
    "lgpl": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-3.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "reserved": ("All rights reserved.",),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
}
FAMILIES = tuple(sorted(TEMPLATES))

DIM_BITS = 14
#: Different paragraphs of the corpus, first in order of a hash, that are trained on as
#: unknown, and the most characters of one: longer ones aren't drawn.
SAMPLE = 3000
SAMPLE_CHARS = 2000
VARIANTS = 60
FALSE_SHARE = 0.001
CONTAINED = 0.75
REACH = 2 * max(len(re.findall(r"[^\W_]+", s)) for sentences in TEMPLATES.values() for s in sentences)
VERSION = re.compile(r"\d+(?:\.\d+)*")


def words_of(text: Column) -> Column:
    split = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(split, lambda w: w != "")


def bigrams_of(words: Column) -> Column:
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    return F.when(n > 1, pairs).otherwise(F.array().cast("array<bigint>"))


def bare_of(words: Column) -> Column:
    """Words without numbers, so that other versions of a licence look alike."""
    return F.filter(words, lambda w: ~w.rlike(r"^\p{N}+$"))


def _bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(1 << DIM_BITS)).cast("int")


def _grams(df: DataFrame) -> DataFrame:
    """From ``words``: buckets of unigrams and bigrams, in two arrays."""
    return df.withColumn("pairs", bigrams_of(F.col("words"))).withColumn("ones", F.transform("words", lambda w: F.xxhash64(w)))


@dataclass(frozen=True)
class Classifier:
    """weights: (2^DIM_BITS, classes), mostly 0; the last class is unknown."""

    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float


def _paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, text) of every line that is not blank."""
    lines = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("paragraph", "text"))
    return lines.filter(F.trim("text") != "")


def _hashed(spark: SparkSession, texts: list[str]) -> list[tuple[list[int], list[int]]]:
    """(buckets, bigram hashes) of each text, by the expressions that score."""
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    rows = _grams(df.select("k", words_of(F.col("text")).alias("words"))).select(
        "k", F.transform(F.concat("ones", "pairs"), _bucket).alias("buckets"), "pairs"
    )
    made = {r["k"]: (r["buckets"], r["pairs"]) for r in rows.collect()}
    return [made[k] for k in range(len(texts))]


def _variants(prose: list[str], rng: random.Random) -> list[tuple[str, int]]:
    """Template sentences as they are, shortened by a word, and embedded in prose.

    A word that tells a family from a related one (lesser, say) is not left out.
    """
    words = [w for t in prose for w in t.split()] or ["text"]
    made = []
    for label, family in enumerate(FAMILIES):
        for sentence in TEMPLATES[family]:
            made += [(sentence, label)] * 10
            for k in range(VARIANTS):
                own = sentence.split()
                if len(own) > 8 and k % 3 == 0:
                    at = rng.randrange(len(own))
                    left = set(_plain_words(" ".join(own[:at] + own[at + 1 :])))
                    if not any(set(_plain_words(t)) <= left for f in FAMILIES if f != family for t in TEMPLATES[f]):
                        del own[at]
                if k % 2:  # other versions
                    own = [VERSION.sub(f"{rng.randrange(1, 5)}.{rng.choice('005')}", w) for w in own]
                some = lambda: [rng.choice(words) for _ in range(rng.randrange(0, 25))]
                made.append((" ".join(some() + own + some()), label))
    return made


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _fit(x: np.ndarray, y: np.ndarray, classes: int, penalty: float = 2e-4, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression with an L1 penalty, by accelerated proximal steps."""
    x = np.column_stack((x, np.ones(len(x), np.float32)))
    want = np.eye(classes, dtype=np.float32)[y]
    step = 1.0 / max(1e-6, 0.5 * float(np.linalg.norm(x, 2)) ** 2 / len(x))
    w = v = np.zeros((x.shape[1], classes), np.float32)
    t = 1.0
    for _ in range(steps):
        after = v - step * (x.T @ (_softmax(x @ v) - want) / len(x))
        after[:-1] = np.sign(after[:-1]) * np.maximum(np.abs(after[:-1]) - step * penalty, 0)
        t_after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = after + (t - 1) / t_after * (after - w)
        w, t = after, t_after
    return w[:-1], w[-1]


def _drawn(docs: DataFrame, sample: int) -> list[str]:
    """At most ``sample`` different paragraphs, the first in order of a hash.

    The number of different ones says up to which hash a few more than that many
    lie; only those leave their tasks, each text once, so what reaches the driver
    doesn't grow with the corpus.
    """
    lines = _paragraphs(docs).select("text").filter(F.length("text") <= SAMPLE_CHARS)
    order = F.xxhash64("text")
    distinct = lines.agg(F.approx_count_distinct(order, 0.02)).first()[0]
    some = lines.withColumn("order", order)
    if distinct > sample:
        share = min(1.0, 1.2 * sample / distinct)
        some = some.filter(F.col("order") <= int(-(2**63) + share * (2**64 - 1)))
    some = some.groupBy("order", "text").count().orderBy("order", "text").limit(sample)
    return [r["text"] for r in some.select("text").collect()]


def train(docs: DataFrame, sample: int = SAMPLE, seed: int = 11) -> Classifier:
    spark, rng = docs.sparkSession, random.Random(seed)
    prose = _drawn(docs, sample)
    known = _hashed(spark, [s for f in FAMILIES for s in TEMPLATES[f]])
    grams = [set(g) for _, g in known]
    # Paragraphs that hold a template aren't examples of unknown ones.
    holds = [max(len(t & set(g)) / len(t) for t in grams) >= CONTAINED for _, g in _hashed(spark, prose)]
    rows = [(t, len(FAMILIES)) for t, with_template in zip(prose, holds) if not with_template]
    rows += [("", len(FAMILIES))] + _variants([t for t, _ in rows], rng)
    rng.shuffle(rows)
    buckets = [b for b, _ in _hashed(spark, [t for t, _ in rows])]
    y = np.array([label for _, label in rows])
    # Only n-grams of templates can speak for a family; the others have weight 0.
    columns = {b: k for k, b in enumerate(sorted({b for found, _ in known for b in found}))}
    x = np.zeros((len(rows), len(columns)), np.float32)
    for i, found in enumerate(buckets):
        for b in found:
            if b in columns:
                x[i, columns[b]] += 1
    held = np.arange(len(rows)) % 5 == 0
    w, bias = _fit(x[~held], y[~held], len(FAMILIES) + 1)
    z = x[held] @ w + bias
    temperature = min(
        (0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=lambda t: -float(np.log(np.maximum(_softmax(z / t)[np.arange(len(z)), y[held]], 1e-12)).mean())
    )
    alien = _softmax(z[y[held] == len(FAMILIES)] / temperature)[:, :-1].max(axis=1)
    least = max(0.5, float(np.quantile(alien, 1 - FALSE_SHARE)) if len(alien) else 0.5)
    weights = np.zeros((1 << DIM_BITS, len(FAMILIES) + 1))
    weights[list(columns)] = np.round(w, 4)
    return Classifier(weights, np.round(bias, 4), temperature, min(least, 0.95))


def _literal(values: np.ndarray, kind: str) -> Column:
    """An array as one literal, folded from text once while planning."""
    told = ",".join("" if v == 0 else f"{v:g}" for v in values.ravel().tolist())
    return F.split(F.lit(told), ",", -1).try_cast(f"array<{kind}>")


def _own_pairs(sentence: str) -> tuple[Column, Column]:
    """A template's distinct bigrams, with numbers and without."""
    words = F.array(*[F.lit(w) for w in _plain_words(sentence)])
    return F.array_distinct(bigrams_of(words)), F.array_distinct(bigrams_of(bare_of(words)))


def _least(sentence: str) -> tuple[set[tuple[str, str]], int]:
    """A template's bigrams without numbers, and how many of them a paragraph that contains it has."""
    words = _plain_words(sentence)
    bare = [w for w in words if not w.isdigit()]
    full, own = set(zip(words, words[1:])), set(zip(bare, bare[1:]))
    numbers = sum(a.isdigit() or b.isdigit() for a, b in full)
    return own, min(math.ceil(CONTAINED * len(own)), math.ceil(CONTAINED * len(full)) - numbers)


def _holds_some(pairs: Column) -> Column:
    """Whether bigrams without numbers are enough for some template to be contained."""
    enough = []
    for sentence in (s for f in FAMILIES for s in TEMPLATES[f]):
        enough.append(F.size(F.array_intersect(_own_pairs(sentence)[1], pairs)) >= _least(sentence)[1])
    return F.array_contains(F.array(*enough), True)


def _key_words() -> list[str]:
    """Words of which every paragraph that contains a template has at least one.

    A paragraph that lacks as many of a template's bigrams as it may still has one
    of any set larger than that; of each template the longest bigrams are that set,
    and the longer word stands for a bigram.
    """
    found = set()
    for own, least in map(_least, (s for f in FAMILIES for s in TEMPLATES[f])):
        ranked = sorted(own, key=lambda p: (-len(p[0]) - len(p[1]), p))
        found |= {max(pair, key=len) for pair in ranked[: len(own) - least + 1]}
    return sorted(found)


def _has_key_word(spark: SparkSession):
    """A test of words that leaves out most paragraphs without a notice, and none with one."""
    buckets = np.zeros(1 << DIM_BITS, int)
    buckets[[b for found, _ in _hashed(spark, _key_words()) for b in found]] = 1
    is_key = _literal(buckets, "int")
    return lambda words: F.exists(words, lambda w: F.get(is_key, _bucket(F.xxhash64(w))).isNotNull())


def _runs(docs: DataFrame) -> DataFrame:
    """Runs of two or more lines of a block that may hold a notice together: doc_id, of, paragraph, last, words."""
    spark = docs.sparkSession
    made = _hashed(spark, [s for f in FAMILIES for s in TEMPLATES[f]])
    bare = _hashed(spark, [" ".join(w for w in _plain_words(s) if not w.isdigit()) for f in FAMILIES for s in TEMPLATES[f]])
    known = F.split(F.lit(",".join(str(h) for h in sorted({h for _, g in made + bare for h in g}))), ",", -1).cast("array<bigint>")
    buckets = np.zeros(1 << DIM_BITS, int)
    buckets[[h % (1 << DIM_BITS) for _, g in bare for h in g]] = 1
    is_known = _literal(buckets, "int")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?im)^[ \t]*(?:rem|dnl)\b", "")
    rows = docs.select("doc_id", F.xxhash64("text").alias("of"), text.alias("text")).filter(F.col("text").contains("\n"))
    some = F.array_distinct(F.filter(bigrams_of(F.col("bare")), lambda h: F.get(is_known, _bucket(h)).isNotNull()))
    # Arrays of one are exploded for the same reason as in the scoring.
    has_key = _has_key_word(spark)
    rows = rows.select("doc_id", "of", "text", F.explode(F.filter(F.array(words_of(F.col("text"))), has_key)).alias("words"))
    rows = rows.withColumn("bare", bare_of(F.col("words")))
    rows = rows.select("doc_id", "of", "text", F.explode(F.array(some)).alias("some")).filter(F.size("some") > 0).filter(_holds_some(F.col("some")))

    def brief(words: Column) -> Column:
        n = F.size(words)
        some = F.least(n, F.lit(REACH))
        return F.struct(F.slice(words, 1, some).alias("first"), F.slice(words, n - some + 1, some).alias("final"), n.alias("n"))

    lines = F.transform(F.transform(F.split("text", "\n", -1), words_of), brief)
    rows = rows.select("doc_id", "of", F.explode(F.array(lines)).alias("lines"))
    each = F.transform("lines", lambda line, i: F.struct(i.alias("i"), line["final"].alias("final"), F.slice("lines", i + 2, REACH + 2).alias("after")))
    rows = rows.select("doc_id", "of", F.inline(each))

    def hits(words: Column) -> Column:
        return F.arrays_overlap(known, F.concat(bigrams_of(words), bigrams_of(bare_of(words))))

    def start(words: Column) -> Column:
        """The first words of a line that its neighbour's pairs can need: numbers and one more."""
        return F.slice(words, 1, 4)

    rows = rows.filter((F.size("final") > 0) & (F.get("after", F.lit(0))["n"] > 0))
    rows = rows.filter(hits(F.concat("final", start(F.get("after", F.lit(0))["first"]))))
    rows = rows.select("doc_id", "of", "i", "final", "after", F.explode(F.sequence(F.lit(1), F.size("after"))).alias("k"))
    between = F.slice("after", 1, F.col("k") - 1)
    last = F.element_at("after", F.col("k"))
    rows = rows.filter(F.forall(F.slice("after", 1, F.col("k")), lambda a: a["n"] > 0))
    rows = rows.filter(F.aggregate(between, F.lit(0), lambda s, a: s + a["n"]) <= REACH)
    previous = F.when(F.col("k") > 1, F.element_at("after", F.greatest(F.col("k") - 1, F.lit(1)))["final"]).otherwise(F.col("final"))
    tail = F.slice(previous, F.greatest(F.size(previous) - 3, F.lit(1)), 4)
    rows = rows.filter(hits(F.concat(tail, last["first"])))
    joined = F.concat("final", F.flatten(F.transform(F.slice("after", 1, F.col("k")), lambda a: a["first"])))
    return rows.select("doc_id", "of", F.col("i").alias("paragraph"), (F.col("i") + F.col("k")).alias("last"), F.explode(F.array(joined)).alias("words"))


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """Licensed paragraphs: doc_id, paragraph, family, probability, contained."""
    keys = ["doc_id", "of", "paragraph", "last"]
    of_text = docs.select("doc_id", "text", F.xxhash64("text").alias("of"))
    lines = of_text.select("doc_id", "of", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("paragraph", "text")).filter(F.trim("text") != "")
    lines = lines.select("doc_id", "of", "paragraph", F.col("paragraph").alias("last"), words_of(F.col("text")).alias("words"))
    found = _scored(lines, model, keys).unionByName(_scored(_runs(docs), model, keys))
    # The smallest runs: the last start for each end, then the first end for each start.
    told = F.struct("paragraph", "last", "probability", "contained")
    found = found.groupBy("doc_id", "of", "family", "last").agg(F.max(told).alias("t")).select("doc_id", "of", "family", "t.*")
    told = F.struct("last", "probability", "contained")
    found = found.groupBy("doc_id", "of", "family", "paragraph").agg(F.min(told).alias("t"))
    found = found.select("doc_id", "of", "family", F.struct("t.last", "paragraph", "t.probability", "t.contained").alias("run"))
    # Of runs that share more than one line, which hold parts of one notice, the first to end counts.
    alone = F.col("run.last") == F.col("run.paragraph")
    runs = found.groupBy("doc_id", "of", "family").agg(
        F.collect_list(F.when(alone, F.col("run"))).alias("lines"), F.sort_array(F.collect_list(F.when(~alone, F.col("run")))).alias("runs")
    )
    apart = F.aggregate(
        "runs",
        F.slice("runs", 1, 0),
        lambda kept, r: F.when((F.size(kept) == 0) | (r["paragraph"] >= F.coalesce(F.get(kept, F.size(kept) - 1)["last"], F.lit(0))), F.concat(kept, F.array(r))).otherwise(kept),
    )
    runs = runs.select("doc_id", "family", F.explode(F.concat("lines", apart)).alias("run"))
    return runs.select("doc_id", "run.paragraph", "family", "run.probability", "run.contained")


def _scored(rows: DataFrame, model: Classifier, keys: list[str]) -> DataFrame:
    """The rows (keys, words) that are notices: keys, family, probability, contained."""
    classes = len(FAMILIES) + 1
    active = np.flatnonzero(np.abs(model.weights).sum(axis=1))
    place = np.zeros(1 << DIM_BITS, int)
    place[active] = np.arange(1, len(active) + 1)
    # Bucket -> row of weights (null for most), found by position in a literal; a weight of 0 is null too.
    row_of = _literal(place, "int")
    has_key = _has_key_word(rows.sparkSession)
    grams = _grams(rows.select(*keys, F.explode(F.filter(F.array("words"), has_key)).alias("words")))
    hits = F.filter(F.transform(F.concat("ones", "pairs"), lambda h: F.get(row_of, _bucket(h))), lambda r: r.isNotNull())
    # A paragraph without any such n-gram is unknown by its bias alone. Exploding
    # an array of one keeps later filters from computing what they test once more.
    weighed = grams.select(*keys, "words", "pairs", F.explode(F.filter(F.array(hits), lambda h: F.size(h) > 0)).alias("hits"))

    def logit(c: int) -> Column:
        weights = _literal(model.weights[active, c], "double")
        total = F.aggregate("hits", F.lit(0.0), lambda s, r: s + F.coalesce(F.get(weights, r - 1), F.lit(0.0)))
        return (total + float(model.bias[c])) / model.temperature

    logits = F.array(*map(logit, range(classes)))
    scored = weighed.select(*keys, "words", "pairs", F.explode(F.array(logits)).alias("z")).withColumn("top", F.array_max("z"))
    scored = scored.withColumns(
        {
            "best": F.array_position("z", F.col("top")).cast("int") - 1,
            "probability": 1 / F.aggregate("z", F.lit(0.0), lambda s, v: s + F.exp(v - F.col("top"))),
        }
    ).filter((F.col("best") < len(FAMILIES)) & (F.col("probability") >= model.least))

    def contained(family: str) -> Column:
        shares = []
        for sentence in TEMPLATES[family]:
            for own, pairs in zip(_own_pairs(sentence), ("pairs", "bare")):
                shares.append(F.size(F.array_intersect(own, F.col(pairs))) / F.size(own))
        return F.greatest(*shares)

    family = F.array(*map(F.lit, FAMILIES))
    share = F.coalesce(*[F.when(F.col("best") == k, contained(f)) for k, f in enumerate(FAMILIES)])
    scored = scored.withColumn("bare", bigrams_of(bare_of(F.col("words"))))
    confirmed = scored.withColumn("contained", share).filter(F.col("contained") >= CONTAINED)
    return confirmed.select(*keys, F.get(family, F.col("best")).alias("family"), F.round("probability", 6).alias("probability"), "contained")


def _plain_words(sentence: str) -> list[str]:
    return [w for w in "".join(c if c.isalnum() else " " for c in sentence.lower()).split()]


def licenses(docs: DataFrame, model: Classifier | None = None) -> DataFrame:
    """Per document: doc_id, families (distinct, sorted), findings (paragraph, family, probability, contained)."""
    docs = docs.select("doc_id", "text")
    model = model or train(docs)
    work = Workings("licenses")
    finding = F.struct("paragraph", "family", "probability", "contained")
    found = work.stage(
        scan(docs, model).groupBy(F.col("doc_id").alias("id")).agg(F.sort_array(F.collect_set(finding)).alias("findings")), "findings"
    )
    rows = docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    none = F.array().cast(found.schema["findings"].dataType)
    rows = rows.select("doc_id", F.coalesce("findings", none).alias("findings"))
    return rows.select("doc_id", F.array_sort(F.array_distinct(F.col("findings.family"))).alias("families"), "findings")


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))
