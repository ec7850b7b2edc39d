"""Personal data: patterned kinds first, then contexts learnt from them.

1. *Seeds.* E-mail addresses, IP addresses, payment cards and phone numbers are
   matched in every whole text by the contract's rules.
2. *Units.* Seeds and other strings that look like identifiers are units: runs of
   tokens (letters, digits, ``_`` and ``-``, with a digit) joined by a space, dot,
   slash, colon or bracket, however short, and of a run of several also each token
   with letters or of eight characters. The words right before and after a unit on
   its line are its lexical patterns; if none stands before it on the line, the last
   word above does.
3. *Bootstrapping.* Patterns and units (by their text) form a bipartite graph. In
   each round Spark scores a pattern by the mean trust of its distinct units,
   keeps those that several trusted units support, and trusts a unit by the
   noisy-or of its patterns. Seeds stay trusted. So contexts of seeds find new
   units, whose other contexts find units that never stood beside a seed's. Trust
   only ever rises; the rounds end when a round adds no unit or pattern and raises
   no trust by more than ``SETTLED``.
4. Units that end up trusted are spans of kind ``identifier``, wherever they stand;
   a run and a token of it may both be.

The text is read once; the graph is narrow rows in the shared folder, aggregated
before each shuffle, and joined as stored tables, so that adaptive execution can
split a pattern that a third of all units share.

Defined cases: null text counts as empty and has no spans; rows equal in id and
text have the same spans; very long texts are scanned in linear time; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Workings, query, table, texts

#: Kinds in the order of the contract; found ones come last.
KINDS = ("email", "ip", "card", "phone", "identifier")

# The contract's expressions. Possessive forms match the same and keep failing texts linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TOKEN = re.compile(r"[A-Za-z0-9_-]++")
#: What may stand between two tokens of one unit.
JOINS = frozenset((" ", "\u00a0", ".", "/", ":", "(", ")", ") ", " ("))
#: Tokens of a longer run are units by themselves from this length on, or if they have letters.
LONG = 8
DIGIT = re.compile(r"[0-9]")
#: Characters of a unit's line that are looked at for its neighbours.
REACH = 48
BEFORE = re.compile(r"(\w+)\W*$")
AFTER = re.compile(r"\W*?(\w+)")

#: Rounds of the plain versions in tests; on the graph rounds go on until nothing changes.
ROUNDS = 4
#: A rise of trust below this adds nothing.
SETTLED = 1e-9
#: A pattern needs this mean trust (one distrusted unit more counted in) and so many trusted units.
PATTERN_TRUST, SUPPORT = 0.6, 3
UNIT_TRUST = 0.6


def emails(text: str) -> list[tuple[int, int]]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(end, at + 1))
    return found


def _is_ip(match: str) -> bool:
    parts = [p.lstrip("0") for p in match.split(".")]
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _is_card(match: str) -> bool:
    digits = [int(c) for c in match if c not in " -"]
    if not 12 <= len(digits) <= 19:
        return False
    doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def _is_phone(match: str) -> bool:
    return 9 <= sum(c.isdigit() for c in match) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterned kinds, by start, then kind."""
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if _is_ip(m[0])]
        found += [("card", *m.span()) for m in CARD.finditer(text) if _is_card(m[0])]
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if _is_phone(m[0])]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _patterns(text: str, start: int, end: int) -> list[str]:
    above = text[max(0, start - REACH) : start]
    before = above.rpartition("\n")[2]
    after = text[end : end + REACH].partition("\n")[0]
    left, right = BEFORE.search(before) or BEFORE.search(above), AFTER.match(after)
    shape = lambda w: DIGIT.sub("#", w.lower())
    return [f"{side}:{shape(m[1])}" for side, m in (("before", left), ("after", right)) if m and not m[1].isdigit()]


def _runs(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of tokens joined to runs (with the bracket that opens or closes one), then those of their tokens that are units too."""
    made, at = [], 0
    while at < len(tokens):
        to = at + 1
        while to < len(tokens) and text[tokens[to - 1][1] : tokens[to][0]] in JOINS:
            to += 1
        start, end = tokens[at][0], tokens[to - 1][1]
        opened, closed = text.count("(", start, end), text.count(")", start, end)
        start -= closed > opened and text[start - 1 : start] == "("
        end += opened > closed and text[end : end + 1] == ")"
        made.append((start, end))
        if to - at > 1:
            made += [(s, e) for s, e in tokens[at:to] if e - s >= LONG or not text[s:e].isdigit()]
        at = to
    return made


def units(text: str, seeds: list[tuple[str, int, int]]) -> list[tuple[int, int, bool, int, list[str]]]:
    """(start, end, is a seed, digest of its text, patterns); other units overlap no seed."""
    spans = [(s, e, True) for _, s, e in seeds]
    if DIGIT.search(text):
        k, by_end, tokens = 0, sorted((s, e) for _, s, e in seeds), []
        for m in TOKEN.finditer(text):
            start, end = m.span()
            while k < len(by_end) and by_end[k][1] <= start:
                k += 1
            if (k == len(by_end) or by_end[k][0] >= end) and DIGIT.search(m[0]):
                tokens.append((start, end))
        spans += [(s, e, False) for s, e in _runs(text, tokens)]
    made = []
    for start, end, seed in spans:
        digest = int.from_bytes(hashlib.blake2b(text[start:end].lower().encode(), digest_size=8).digest(), "big", signed=True)
        made.append((start, end, seed, digest, _patterns(text, start, end)))
    return made


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_UNIT = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), ("unit", pa.int64()), ("patterns", pa.list_(pa.string()))])
_SCAN_SCHEMA = (
    "doc_id long, digest binary, base array<struct<kind: string, start: int, end: int>>, "
    "units array<struct<start: int, end: int, seed: boolean, unit: long, patterns: array<string>>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, bases, found = [], [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            digests.append(hashlib.blake2b(text.encode(), digest_size=16).digest())
            bases.append([dict(zip(("kind", "start", "end"), s)) for s in base])
            found.append([dict(zip(("start", "end", "seed", "unit", "patterns"), u)) for u in units(text, base)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(bases, pa.list_(_SPAN)), pa.array(found, pa.list_(_UNIT))],
            names=["doc_id", "digest", "base", "units"],
        )


def _trusted_units(work: Workings, occurrences: DataFrame, rounds: int | None = None) -> DataFrame:
    """(unit) of those trusted without being seeds, when the rounds on the graph (at most ``rounds`` if given) change nothing more."""
    links = work.stage(
        occurrences.select("unit", "seed", F.explode("patterns").alias("pattern")).groupBy("pattern", "unit").agg(F.max("seed").alias("seed")), "links"
    )
    trust, before, done = None, (0, 0, 0.0), 0
    while rounds is None or done < rounds:
        scored = links.withColumn("trust", F.col("seed").cast("double"))
        if trust is not None:
            scored = links.join(trust, "unit", "left").withColumn(
                "trust", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("trust", F.lit(0.0)))
            )
        good = F.col("trust") >= UNIT_TRUST
        patterns = (
            scored.groupBy("pattern")
            .agg((F.sum("trust") / (F.count(F.lit(1)) + 1)).alias("worth"), F.sum(good.cast("int")).alias("support"))
            .filter((F.col("worth") >= PATTERN_TRUST) & (F.col("support") >= SUPPORT))
        )
        patterns = work.stage(patterns.select("pattern", "worth"), "patterns")
        doubt = F.exp(F.sum(F.log(1 - F.least("worth", F.lit(0.999)))))
        after = links.filter(~F.col("seed")).join(patterns, "pattern").groupBy("unit").agg((1 - doubt).alias("trust"))
        trust = work.stage(after.filter(F.col("trust") >= UNIT_TRUST), "trust")
        # Units, patterns and the sum of trust of this round: all three can only rise.
        reached = trust.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("trust"), F.lit(0.0)).alias("total")).first()
        now, done = (reached["n"], patterns.count(), reached["total"]), done + 1
        if now[:2] == before[:2] and now[2] - before[2] <= SETTLED * max(1, now[0]):
            break
        before = now
    return trust.select("unit")


def personal_data(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """Per document: doc_id, base and found (arrays of kind, start, end)."""
    work = Workings("pii")
    scanned = work.stage(texts(docs).mapInArrow(_scan, _SCAN_SCHEMA), "scan")
    occurrences = work.stage(scanned.select("doc_id", "digest", F.explode("units").alias("u")).select("doc_id", "digest", "u.*"), "units")
    trusted = _trusted_units(work, occurrences, rounds)
    span = F.struct(F.lit(KINDS[-1]).alias("kind"), "start", "end")
    # Rows equal in id and text give equal spans, which count once.
    found = (
        occurrences.filter(~F.col("seed")).join(trusted, "unit")
        .groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set(span)).alias("found"))
    )
    found = work.stage(found.select(F.col("doc_id").alias("id"), F.col("digest").alias("of"), "found"), "found")
    rows = scanned.select("doc_id", "digest", "base")
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["id"]) & (rows["digest"] == found["of"]), "left")
    none = F.array().cast("array<struct<kind: string, start: int, end: int>>")
    return joined.select("doc_id", "base", F.coalesce("found", none).alias("found"))


def span_text(spans):
    """kind:start:end by start, then kind, comma-joined."""
    order = F.create_map(*[x for k, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(k))])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    told = F.transform(F.sort_array(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(told, ",")


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in KINDS[:4]],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.concat("base", "found")).alias("spans"),
    )
