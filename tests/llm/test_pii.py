import hashlib
import random
import re
import time

from ledgerline.llm import pii

EXPRESSIONS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, match):
    digits = re.sub(r"[^0-9]", "", match)
    return {
        "email": True,
        "ip": all(int(p) <= 255 for p in match.split(".")) if kind == "ip" else True,
        "card": 12 <= len(digits) <= 19 and luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def plain(text):
    found = [(m.start(), n, m.end(), k) for n, (k, e) in enumerate(EXPRESSIONS.items()) for m in re.finditer(e, text) if good(k, m[0])]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def told(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_base_spans_equal_the_expressions():
    r = random.Random(5)
    pieces = ["a@b.co", "x.y+z@mail.example.com", "@", ".", "..", "1.2.3.4", "256.1.1.1", "0001.2.3.255", "+1 (706) 555-3138", "+12", "4111 1111 1111 1111",
              "4111111111111111", "123456789012", "-", " ", "(", ")", "é", "漢", "\n", "%", "word", "@@", "a@b", "a@b.c.d@e.f", "+", "5", "79927398713000"]
    for _ in range(4000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(12)))
        assert pii.base_spans(text) == plain(text), text
    for alphabet in ("0123 -", "1.2", "ab@.", "+1 ()-."):
        for _ in range(1500):
            text = "".join(r.choice(alphabet) for _ in range(r.randrange(60)))
            assert pii.base_spans(text) == plain(text), text


def test_long_texts_take_linear_time():
    for text in ("a" * 300000, "1" * 300000, "a@" * 150000, "1." * 150000, "+1(" * 100000, "1 " * 150000, "x@" + "a." * 100000 + "@", "-" * 300000, "_9" * 150000):
        began = time.time()
        pii.units(text, pii.base_spans(text))
        assert time.time() - began < 3, text[:10]


def trust(rows, rounds=pii.ROUNDS):
    """The graph's rounds in dictionaries: rows are (doc_id, text); trusted units that are no seeds."""
    links = {}
    for _, t in rows:
        t = t or ""
        for _, _, seed, unit, patterns in pii.units(t, pii.base_spans(t)):
            for p in patterns:
                links[p, unit] = links.get((p, unit), False) or seed
    score = {}
    for _ in range(rounds):
        by = {}
        for (p, u), seed in links.items():
            by.setdefault(p, []).append(1.0 if seed else score.get(u, 0.0))
        worth = {p: sum(x) / (len(x) + 1) for p, x in by.items() if sum(v >= pii.UNIT_TRUST for v in x) >= pii.SUPPORT}
        worth = {p: w for p, w in worth.items() if w >= pii.PATTERN_TRUST}
        doubt = {}
        for (p, u), seed in links.items():
            if not seed and p in worth:
                doubt[u] = doubt.get(u, 1.0) * (1 - min(worth[p], 0.999))
        score = {u: 1 - d for u, d in doubt.items() if 1 - d >= pii.UNIT_TRUST}
    return set(score)


def brute_force(rows):
    trusted = trust(rows)
    out = []
    for k, t in rows:
        t = t or ""
        base = plain(t)
        found = [("identifier", s, e) for s, e, seed, u, _ in pii.units(t, base) if not seed and u in trusted]
        both = sorted(base + found, key=lambda s: (s[1], pii.KINDS.index(s[0])))
        counts = [sum(s[0] == kind for s in base) for kind in pii.KINDS[:4]]
        out.append((k, *counts, hashlib.sha256(told(base).encode()).hexdigest(), told(both)))
    return sorted(out, key=str)


def corpus():
    mails = [f"write to user{k}@mail.example.com today" for k in range(30)]
    keys = [f"write to AKIA{k}QQ77TTXX today" for k in range(4)]
    keys += [f"write to key{k}abc99def today\nsecret = key{k}abc99def done" for k in range(8)]
    rows = list(enumerate(mails + keys + ["secret = zz81828384yy", "version = build20240101x here", None, "", "no data at all", "x" * 100000]))
    return rows + [(None, "mail a@b.co"), (3, mails[3]), (3, mails[3]), (3, "secret = hidden1234567")]


def test_contexts_find_unseen_identifiers(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, digest string")
    found = pii.personal_data(docs).collect()
    texts = {t[s.start : s.end] for r in found for s in r.found for k, t in rows if k == r.doc_id and t and len(t) > s.end - 1 and s.end <= len(t)}
    assert "AKIA1QQ77TTXX" in texts and "zz81828384yy" in texts
    assert not any("build20240101x" == t for t in texts)
    assert len(found) == len(rows)
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_query_equals_dictionaries(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in pii.op9_pii(spark, sf).collect()), key=str)
    assert got == brute_force(rows)


def test_odd_rows_equal_dictionaries(spark, tmp_path):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((tuple(r) for r in pii.op9_pii(spark, str(tmp_path)).collect()), key=str) == brute_force(corpus())


def candidates(text):
    return {text[s:e] for s, e, seed, _, _ in pii.units(text, pii.base_spans(text)) if not seed}


def test_spaced_and_short_identifiers_are_candidates():
    for unit in ("DE89 3704 0044 0532 0130 00", "123 45 6789", "EMP1234", "(136) 555-7479", "12.345.678/0001-95", "A1(12)9"):
        assert unit in candidates(f"label {unit} follows"), unit
    assert candidates("EMP1234 10.1.2.3 AB12") == {"EMP1234", "AB12"}
    assert "EMP1234" in candidates("given EMP1234 3 times")
    assert candidates("no digits - at (all)") == set()
    (unit,) = pii.units("iban:\n  DE89 3704 0044", [])[:1]
    assert unit[4] == ["before:iban"]


def chained(depth):
    """Units that are ``depth`` contexts away from the seeds, some spaced and some short."""
    rows = [f"c user{k}@mail.example.com" for k in range(30)]
    for d in range(depth):
        rows += [f"c{'x' * (d + 1)} seed{d}a{k}@mail.example.com" for k in range(14)]
        for k in range(6):
            unit = f"{d + 10} {k + 20} 77" if d % 2 else f"E{d}{k}"
            rows += [f"c{'x' * d} {unit}", f"c{'x' * (d + 1)}\n{unit}"]
    return [(n, t) for n, t in enumerate(rows)]


def test_rounds_go_on_until_no_unit_is_added(spark):
    rows = chained(9)
    want = trust(rows, rounds=40)
    assert len(want) > len(trust(rows))
    found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_id = dict(rows)
    got = {by_id[r.doc_id][s.start : s.end] for r in found for s in r.found}
    told = {int.from_bytes(hashlib.blake2b(t.lower().encode(), digest_size=8).digest(), "big", signed=True) for t in got}
    assert told == want
    assert {"E00", "E85", "17 25 77"} <= got
