"""Document fingerprints by content-defined chunking.

A gear hash over the last 16 bytes marks places where a text may be cut; cutting
is normalised: before the usual chunk size only rarer marks count, after it also
common ones. Cuts depend on nearby bytes only, so an insertion changes the chunks
around it and no others. The fingerprint is the set of chunk digests with their
lengths; the likeness of two is the share of the first one's bytes that lie in
chunks of the second (containment weighted by length).

``neighbour_fingerprints`` compares each document with its edited text and with
the next document. Documents are dealt by ranges of ids; the first row of each
range also goes to the range that comes before it, so each range finds all its
neighbours with one shuffle of the texts.

Defined cases: null text counts as empty, its fingerprint is the empty string;
empty against empty is 1, empty against other text 0; a null id comes last; rows
equal in id are ordered by text; a single document is its own next one.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import query, table, texts

MIN_BYTES, USUAL_BYTES, MAX_BYTES = 16, 32, 128
#: A mark is a hash whose top bits are 0: so many bits before the usual size, and after it.
RARE_BITS, COMMON_BITS = 6, 4
NULL_ID = -(1 << 63)

_GEAR = np.random.Generator(np.random.PCG64(20240607)).integers(0, 1 << 16, 256).astype(np.uint16)


def _gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash (16 bits) of the last 16 bytes, by doubling the reach."""
    h = _GEAR[data]
    for reach in (1, 2, 4, 8):
        longer = h.copy()
        longer[reach:] += h[:-reach] << np.uint16(reach)
        h = longer
    return h


def chunk_sets(texts_utf8: list[bytes]) -> list[np.ndarray]:
    """For each text its sorted distinct chunks, packed: 48 bits of digest, 16 of length.

    All texts are hashed in one pass; the least chunk is as long as the hash's
    reach, so no cut depends on the text before.
    """
    joined = b"".join(texts_utf8)
    data = np.frombuffer(joined, np.uint8)
    hashes = _gear_hashes(data) if len(data) else np.zeros(0, np.uint16)
    common = np.flatnonzero(hashes >> np.uint16(16 - COMMON_BITS) == 0) + 1
    rare = common[hashes[common - 1] >> np.uint16(16 - RARE_BITS) == 0]
    common, rare = common.tolist(), rare.tolist()
    made, at, digest = [], 0, xxhash.xxh64_intdigest
    n_common, n_rare = len(common), len(rare)
    for text in texts_utf8:
        end, packed = at + len(text), []
        while at < end:
            cut = min(at + MAX_BYTES, end)
            k = bisect_left(rare, at + MIN_BYTES)
            if k < n_rare and rare[k] < at + USUAL_BYTES:
                cut = min(cut, rare[k])
            else:
                k = bisect_left(common, at + USUAL_BYTES)
                if k < n_common:
                    cut = min(cut, common[k])
            packed.append((digest(joined[at:cut]) & ~0xFFFF) | (cut - at))
            at = cut
        made.append(np.unique(np.array(packed, dtype=np.uint64)))
    return made


def likeness(own: np.ndarray, other: np.ndarray) -> float:
    """Share of ``own``'s bytes in chunks that ``other`` has too."""
    if not len(own) or not len(other):
        return float(len(own) == len(other))
    weight = lambda x: int((x & np.uint64(0xFFFF)).sum())
    return weight(np.intersect1d(own, other, assume_unique=True)) / weight(own)


def as_text(chunks: np.ndarray) -> str:
    return base64.b64encode(chunks.astype(">u8").tobytes()).decode()


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = chunk_sets([t.encode() for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "fingerprint": pa.array([as_text(s) for s in sets], pa.string())}
            )

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_PAIR_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(rows: list[tuple]) -> pa.RecordBatch:
    """rows: (doc_id, text, next text)."""
    ids, own, following = zip(*rows)
    changed = [edited(a, b).encode() for a, b in zip(own, following)]
    n = len(rows)
    sets = chunk_sets([*(t.encode() for t in own), *changed, *(t.encode() for t in following[-1:])])
    mine, other = sets[:n], sets[n : 2 * n]
    # The next document is the next row, but for where a range of ids ends.
    after = [mine[k + 1] if k + 1 < n and own[k + 1] is following[k] else None for k in range(n)]
    after[-1] = sets[2 * n]
    for k in [k for k in range(n) if after[k] is None]:
        after[k] = chunk_sets([following[k].encode()])[0]
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "n_chars": pa.array([len(t) for t in own], pa.int64()),
            "edited_sha256": [hashlib.sha256(t).hexdigest() for t in changed],
            "fingerprint": [as_text(s) for s in mine],
            "edited_fingerprint": [as_text(s) for s in other],
            "near_edited": [likeness(a, b) for a, b in zip(mine, other)],
            "near_next": [likeness(a, b) for a, b in zip(mine, after)],
        }
    )


def neighbour_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and its edited text, and their likeness (see the module).

    ``ranges``: of ids; by default four for each shuffle partition. Their bounds
    are all that the driver holds.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * partitions
    keyed = texts(docs).withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
    shares = [k / ranges for k in range(1, ranges)]
    bounds = keyed.agg(F.percentile_approx("key", shares or [0.5], 10 * ranges).alias("b")).first()["b"] or []
    bounds = np.unique(np.array(bounds, dtype=np.int64))

    def range_of(keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds, keys, "right")

    def first_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            yield pa.RecordBatch.from_pydict({"range": range_of(keys).astype(np.int32), "key": keys})

    # The first row of a range, in descending order, is its greatest id.
    firsts = sorted(
        (r["range"], r["first"])
        for r in keyed.select("key").mapInArrow(first_of, "range int, key long").groupBy("range").agg(F.max("key").alias("first")).collect()
    )
    # That row also goes where the range above ends; the greatest of all, where the lowest ends.
    also = {first: firsts[(k + 1) % len(firsts)][0] for k, (_, first) in enumerate(firsts)}
    heads = np.array(sorted(also), dtype=np.int64)
    goes = np.array([also[h] for h in heads.tolist()], dtype=np.int32)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            place = np.minimum(np.searchsorted(heads, keys), max(0, len(heads) - 1))
            again = np.flatnonzero(heads[place] == keys)
            for rows, target, guest in (
                (batch, range_of(keys).astype(np.int32), False),
                (batch.take(pa.array(again)), goes[place[again]], True),
            ):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(target, pa.int32()), pa.array([guest] * rows.num_rows, pa.bool_()), *rows.columns],
                    names=["range", "guest", *rows.schema.names],
                )

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ready, size = None, [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text"))):
                if last is not None and last[0] == row[0] and not last[1]:
                    ready.append((last[2], last[3], row[3]))
                    size += len(last[3])
                last = row
                if size > 4_000_000 or len(ready) >= 4000:
                    yield _compare(ready)
                    ready, size = [], 0
        if ready:
            yield _compare(ready)

    dealt = keyed.mapInArrow(deal, "range int, guest boolean, doc_id long, text string, key long")
    return (
        dealt.repartition(partitions, "range")
        .sortWithinPartitions("range", "guest", F.desc("key"), "text")
        .mapInArrow(pair, _PAIR_SCHEMA)
    )


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))
