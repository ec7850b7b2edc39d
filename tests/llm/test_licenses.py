import math
import re

import pytest
import xxhash

from ledgerline.llm import licenses as lc


@pytest.fixture(scope="module")
def model(spark, sf):
    return lc.train(spark.read.parquet(f"{sf}/documents.parquet"))


def grams(text):
    words = re.findall(r"[^\W_]+", text.lower())
    one = lambda w, seed: xxhash.xxh64_intdigest(w.encode(), seed=seed)
    return [one(w, 42) for w in words], [one(b, one(a, 42)) for a, b in zip(words, words[1:])]


def brute_force(rows, model):
    """rows: (doc_id, text) -> per id the findings (paragraph, family)."""
    out = {}
    for k, text in rows:
        found = out.setdefault(k, set())
        for n, line in enumerate((text or "").split("\n")):
            ones, pairs = grams(line)
            signed = [h - (1 << 64) if h >> 63 else h for h in ones + pairs]
            hits = [h % (1 << lc.DIM_BITS) for h in signed]
            hits = [h for h in hits if abs(model.weights[h]).sum() > 0]
            if not hits:
                continue
            z = (sum(model.weights[h] for h in hits) + model.bias) / model.temperature
            best = int(z.argmax())
            if best == len(lc.FAMILIES) or 1 / sum(math.exp(v - z[best]) for v in z) < model.least:
                continue
            share = max(len(set(grams(s)[1]) & set(pairs)) / len(set(grams(s)[1])) for s in lc.TEMPLATES[lc.FAMILIES[best]])
            if share >= lc.CONTAINED:
                found.add((n, lc.FAMILIES[best]))
    return out


def test_query_equals_plain_scoring(spark, sf, model):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_force(rows, model)
    got = lc.op1_license_scan(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        assert {(f.paragraph, f.family) for f in r.findings} == want[r.doc_id]
        assert r.families == sorted({f for _, f in want[r.doc_id]})


def test_templates_and_prose(spark, model):
    rows, want = [], {}
    for n, (family, sentences) in enumerate(sorted(lc.TEMPLATES.items())):
        for m, s in enumerate(sentences):
            k = 100 * n + m
            rows += [(k, f"Some prose here.\n{s}\nmore prose"), (k + 50, f"words before it {s.upper()} and words after it")]
            want[k] = want[k + 50] = family
    prose = ["The license plate was apache red", "a version 2.0 of the general public opinion", "permission was granted to any person", "use in source and other forms"]
    rows += [(9000 + k, t) for k, t in enumerate(prose)]
    got = {r.doc_id: r.families for r in lc.licenses(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for k, family in want.items():
        assert got[k] == [family], (k, got[k])
    assert all(got[9000 + k] == [] for k in range(len(prose)))


def test_odd_rows(spark, model):
    mit = lc.TEMPLATES["mit"][0]
    rows = [(1, None, "a"), (2, "", "a"), (None, mit, "b"), (3, mit, "c"), (3, mit, "c"), (4, "\n\n " + mit + "\n", "d"), (5, "word " * 50000 + mit, "e"), (6, "!!!", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, findings string")
    got = sorted(((r.doc_id, tuple(r.families), [f.paragraph for f in r.findings]) for r in lc.licenses(docs, model).collect()), key=str)
    want = [(1, (), []), (2, (), []), (None, ("mit",), [0]), (3, ("mit",), [0]), (3, ("mit",), [0]), (4, ("mit",), [2]), (5, ("mit",), [0]), (6, (), [])]
    assert got == sorted(want, key=str)
    assert lc.licenses(docs.limit(0)).count() == 0


WRAPPED = {
    "mit": """# Copyright (c) someone
#
# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software"), to deal
# in the Software without restriction""",
    "bsd": """ * words of a file
 *
 * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:""",
    "gpl": """// This is a file

// This program is free software: you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation, either version 3 of the License, or""",
}


def test_wrapped_notices(spark, model):
    narrow = "\n".join(lc.TEMPLATES["mit"][2].split())
    cc = "This work is licensed under a Creative Commons\nAttribution 3.0 Unported License."
    rows = list(enumerate(WRAPPED.values()))
    rows += [(10, "prose before\n" + cc), (11, "one\n\n" + narrow), (12, WRAPPED["mit"] + "\nAll rights reserved.\n" + WRAPPED["bsd"])]
    rows += [(13, "rem Permission is hereby granted, free of charge, to any person\nrem obtaining a copy of this software and associated\nrem documentation files")]
    # A blank line ends a block; nothing is found across it.
    rows += [(14, "Permission is hereby granted, free of charge, to any person\n\nobtaining a copy of this software and associated documentation files")]
    rows += [(15, "Released under the MIT License.\nReleased under the MIT License.\nsome words here")]
    got = {r.doc_id: [(f.paragraph, f.family) for f in r.findings] for r in lc.licenses(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[k] for k in range(3)] == [[(2, "mit")], [(2, "bsd")], [(2, "gpl")]]
    assert got[10] == [(1, "cc_by")] and got[11] == [(2, "mit")] and got[13] == [(0, "mit")]
    assert got[12] == [(2, "mit"), (5, "reserved"), (8, "bsd")]
    assert got[14] == [] and got[15] == [(0, "mit"), (1, "mit")]


def test_other_versions(spark, model):
    rows = [
        (1, "Licensed under CC BY 3.0."),
        (2, "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
        (3, "Licensed under CC BY-SA 2.5."),
        (4, "This work is licensed under the GNU General Public License, version 2."),
    ]
    got = {r.doc_id: r.families for r in lc.licenses(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got == {1: ["cc_by"], 2: ["cc_by"], 3: ["cc_by_sa"], 4: ["gpl"]}


def test_related_licences_are_told_apart(spark, model):
    want = {
        "This library is licensed under the GNU Lesser General Public License, version 2.1.": "lgpl",
        "This program is licensed under the GNU Affero General Public License, version 3.": "agpl",
        "This text is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "cc_by_nc_sa",
        "Licensed under CC BY-NC-SA 3.0.": "cc_by_nc_sa",
        "Licensed under CC BY-ND 4.0.": "cc_by_nd",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided": "isc",
        "// SPDX-License-Identifier: MIT": "mit",
        "# SPDX-License-Identifier: LGPL-2.1-or-later": "lgpl",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies it": "epl",
        "This is free and unencumbered software released into the public domain.": "unlicense",
    }
    wrapped = """ * you can redistribute it and/or modify
 * it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either"""
    rows = [*enumerate(want), (100, wrapped), (101, "The GNU project and the Lesser General of a public office, version 3"), (102, "an Eclipse of the public sun")]
    got = {r.doc_id: r.families for r in lc.licenses(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for k, text in enumerate(want):
        assert got[k] == [want[text]], (text, got[k])
    assert got[100] == ["lgpl"] and got[101] == [] and got[102] == []


def test_the_sample_is_bounded(spark):
    rows = [(k, f"a line of number {k}\n" + "same line\n" * 5 + "long " * 1000) for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drawn = lc._drawn(docs, 100)
    assert 80 <= len(drawn) <= 100 and len(set(drawn)) == len(drawn) and max(map(len, drawn)) <= lc.SAMPLE_CHARS
    assert drawn == lc._drawn(docs.repartition(7), 100)
    assert len(lc._drawn(docs, 5000)) == 801


def test_key_words_leave_out_no_template(spark):
    keys = set(lc._key_words())
    for sentence in (s for f in lc.FAMILIES for s in lc.TEMPLATES[f]):
        own, least = lc._least(sentence)
        without = [p for p in own if not keys & set(p)]
        assert len(without) < least, sentence
