"""Similarity join on word n-grams (five words, Jaccard 0.8) by chosen paths.

Texts with the same set of shingles are one node. Each node samples about
1/threshold of its shingles in each of several runs; a sampled shingle is a
bucket, so similar sets meet often. Then, level by level:

* a small bucket is compared within: pairs that pass a size bound and a 64-bin
  one-permutation sketch are candidates, checked on their whole sets later;
* a large bucket whose members are alike on average (from counts of sketch bits,
  over all members) would not fall apart. Such buckets that share members become
  one grid, so a group of near copies is compared once and not once for each of
  its paths: within blocks, on whole sets, a cell being a task. A cell gives
  counts of links and a spanning tree of what is connected, never its pairs;
* any other large bucket is split: its members sample again among their shingles,
  and the sampled shingle extends the path.

The number of runs follows from the target recall and the chance that a pair at
the threshold shares a path in one run. A node is in one grid at most and pairs
within a grid are counted there alone. Classes are connected components.

Defined cases: words are stretches of letters and digits (and whatever else is not
ASCII) in lower case, so punctuation and capitals don't tell texts apart; a text of
one to four words is one shingle; texts without words, null and empty ones too, form
one node; rows equal in id count as copies; a null id never is a class id unless
a class has no other; extra columns are ignored by ``near_classes`` and kept by
``drop_near_duplicates``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import FILTER_BITS, Workings, membership, query, table, tasks_for, texts, together, with_maybe
from ledgerline.llm.components import components

WORDS = 5
THRESHOLD = 0.8
#: Target share of pairs at the threshold that are found, and the chance per run that is relied on.
RECALL, RUN_CHANCE = 0.999, 0.5
#: Larger buckets are split.
SMALL = 50
#: Mean estimated similarity from which a large bucket is compared as a whole.
ALIKE = 0.6
#: Members of a block of a grid.
BLOCK = 512
MOST_LEVELS = 12
#: Whole sets that one task reads to extend their paths.
SETS_PER_TASK = 2000
#: Bits of the filter of sampled shingles that occur again (4 MB at most, see FILTER_BITS).
KEY_BITS = 1 << 24
#: Sketches are compared if both sets have so many shingles; so many of 64 bins must agree.
SKETCH_FROM, SKETCH_SHARE = 64, 0.72

_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_IN_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_RANDOM = np.random.Generator(np.random.PCG64(5))
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACES = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_SEEDS = _RANDOM.integers(1, 1 << 63, (256, 2), dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of murmur3."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, 2 * len(self.up), 1 << 16)
            steps = np.full(n, _BASE, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = pow(_BASE, -1, 1 << 64)
            self.down = np.cumprod(steps)
        return self.up, self.down


_POWERS = _Powers()


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    solid = _IN_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], solid.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _POWERS.to(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)])))
    words = _mix((sums[ends] - sums[starts]) * down[starts])
    if len(words) < WORDS:
        return _mix((words * _PLACES[: len(words)]).sum(keepdims=True) + np.uint64(len(words)))
    n = len(words) - WORDS + 1
    made = np.zeros(n, np.uint64)
    for k in range(WORDS):
        made += words[k : k + n] * _PLACES[k]
    return np.unique(_mix(made))


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _sketch(tokens: np.ndarray) -> tuple[int, int]:
    """One-permutation sketch: which of 64 bins have a shingle, and a bit of the least one in each."""
    order = np.sort(tokens * _M3)
    first = np.searchsorted(order, np.arange(64, dtype=np.uint64) << np.uint64(58))
    last = np.concatenate((first[1:], [len(order)]))
    there = first < last
    bit = np.zeros(64, bool)
    bit[there] = (order[first[there]] >> np.uint64(20)) & np.uint64(1) == 1
    pack = lambda x: int(np.packbits(x).view(">i8")[0])
    return pack(there), pack(bit)


def _limit(n: int, threshold: float) -> np.uint64:
    return np.uint64(min(2**64 - 1, int(2**64 / (threshold * n))))


def first_paths(tokens: np.ndarray, runs: int, threshold: float) -> np.ndarray:
    """The buckets of the first level: sampled shingles of every run."""
    if not len(tokens):
        return np.zeros(0, np.int64)
    seeds = _SEEDS[:runs]
    run, at = np.nonzero(tokens[None, :] * seeds[:, :1] + seeds[:, 1:] <= _limit(len(tokens), threshold))
    return _mix(tokens[at] ^ seeds[run, 1]).view(np.int64)


def longer_paths(tokens: np.ndarray, path: int, threshold: float) -> np.ndarray:
    """A path extended by the shingles sampled for it."""
    seed = _mix(np.array([path], np.int64).view(np.uint64))
    drawn = tokens[_mix(tokens * _M3 ^ seed) <= _limit(len(tokens), threshold)]
    return _mix(drawn * _M2 ^ seed).view(np.int64)


def stored(tokens: np.ndarray) -> bytes:
    """A set as it is kept: 32 bits of each shingle."""
    return np.unique((tokens >> np.uint64(32)).astype("<u4")).tobytes()


def loaded(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4")


_NODE_SCHEMA = "doc_id long, node binary, size int, there long, bits long, paths array<long>, tokens binary"


def _describe(runs: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = []
                for text in part.column("text").to_pylist():
                    tokens = shingles(text)
                    rows.append((_digest(tokens), len(tokens), *_sketch(tokens), first_paths(tokens, runs, threshold), stored(tokens)))
                node, size, there, bits, paths, kept = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(node, pa.binary()), pa.array(size, pa.int32()), pa.array(there, pa.int64()),
                        pa.array(bits, pa.int64()), pa.array(paths, pa.list_(pa.int64())), pa.array(kept, pa.binary()),
                    ],
                    names=["doc_id", "node", "size", "there", "bits", "paths", "tokens"],
                )

    return run


def _sets_of(described: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """(node, tokens) of the given nodes, each once; other sets are left out before any shuffle."""
    wanted = membership(nodes, ["node"], bits)
    sets = with_maybe(described.select("node", "tokens"), ["node"], wanted, "maybe", bits).filter("maybe").drop("maybe")
    return sets.dropDuplicates(["node"])


def _extend(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys = [], []
            for node, paths, tokens in zip(*(batch.column(c).to_pylist() for c in ("node", "paths", "tokens"))):
                held = loaded(tokens).astype(np.uint64)
                for path in paths:
                    longer = longer_paths(held, path, threshold).tolist()
                    nodes += [node] * len(longer)
                    keys += longer
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(keys, pa.int64())], names=["node", "key"])

    return run


def _similar(common, a, b, threshold: float):
    return common >= threshold * (a + b - common) - 1e-9


def _compare_cell(threshold: float):
    """A cell of a grid: counts of links and a spanning tree, from whole sets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["i"].iloc[0], pdf["j"].iloc[0]
        pdf = pdf.sort_values("node").reset_index(drop=True)
        sets = [loaded(t) for t in pdf["tokens"]]
        n, sizes = len(sets), np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(n), sizes)
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = np.cumsum(times > 1) - 1
        keep = times[column] > 1
        owner, column = owner[keep], shared[column[keep]]
        common = np.zeros((n, n), np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for begin in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            lo, hi = np.searchsorted(column, (begin, begin + 4096))
            part = np.zeros((n, 4096), np.float32)
            part[owner[lo:hi], column[lo:hi] - begin] = 1
            common += part @ part.T
        linked = _similar(common, sizes[:, None], sizes[None, :], threshold)
        np.fill_diagonal(linked, False)
        block = pdf["block"].to_numpy()
        if i != j:
            linked &= block[:, None] != block[None, :]
        count = linked.sum(axis=1).astype(np.int64)
        root = np.arange(n)

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a in range(n):
            for b in np.flatnonzero(linked[a, a + 1 :]) + a + 1:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
        return pd.DataFrame({"node": pdf["node"], "links": count, "to": [pdf["node"][top(x)] for x in range(n)]})

    return run


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([loaded(t) for t in batch.column(c).to_pylist()] for c in ("a_tokens", "b_tokens"))
            good = [
                bool(_similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), threshold)) for x, y in zip(a, b)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def near_classes(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, small: int = SMALL, block: int = BLOCK, bits: int = FILTER_BITS
) -> DataFrame:
    """One row per document: doc_id, rep_id, copies, n_links, class_id.

    ``rep_id``: the least doc_id with the same shingles, ``copies`` their number;
    ``n_links``: different sets similar to this one; ``class_id``: the least
    doc_id of the connected class.
    """
    found = _classes(docs, threshold, recall, small, block, bits)
    return found.select("doc_id", "rep_id", "copies", "n_links", "class_id")


def _classes(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, small: int = SMALL, block: int = BLOCK, bits: int = FILTER_BITS
) -> DataFrame:
    """As ``near_classes``, with node (a digest of the shingles) and head (the node that stands for the class)."""
    work = Workings("jaccard")
    runs = math.ceil(math.log(1 - recall) / math.log(1 - RUN_CHANCE))
    described, n_docs = work.stage_counted(texts(docs).mapInArrow(_describe(runs, threshold), _NODE_SCHEMA), "sets")
    few = tasks_for(docs.sparkSession, n_docs)
    members = described.select("doc_id", "node")
    nodes = work.stage(members.groupBy("node").agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("copies")), "nodes", few)

    faces = described.select("node", "size", "there", "bits")
    # Equal sets have equal paths: a node's rows for a key count once.
    rows, n_rows = work.stage_counted(_meeting(described.select("node", "size", "there", "bits", F.explode("paths").alias("key"))), "level")
    kept, candidates, alike_rows = [], [], []
    for level in range(1, MOST_LEVELS + 1):
        # Later levels have few rows: they are written by as few tasks as they need, and very few
        # are worked on in one. What follows has no more rows than the level until paths are extended.
        tasks = tasks_for(docs.sparkSession, n_rows)
        sizes = work.stage(together(rows, n_rows).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets", tasks)
        counted = work.stage(together(rows, n_rows).join(_sorted(together(sizes, n_rows)), "key"), "counted", tasks)
        work.drop(rows, sizes)
        kept.append(counted)
        near = together(counted, n_rows)
        candidates.append(_pairs(near.filter(F.col("n") <= small).drop("n"), threshold))
        large = near.filter(F.col("n") > small).select("key", "node", "bits")
        alike = work.stage(_alike(large, level == MOST_LEVELS), "alike", tasks)
        judged = together(alike, n_rows)
        alike_rows.append(large.select("key", "node").join(_sorted(judged.filter("dense").select("key")), "key"))
        open_rows = large.select("key", "node").join(_sorted(judged.filter("NOT dense").select("key")), "key")
        paths, n_open = work.stage_counted(open_rows.groupBy("node").agg(F.collect_list("key").alias("paths")), "open", tasks)
        if not n_open:
            break
        held = together(paths, n_open)
        longer = _sorted(held).join(_sets_of(described, held.select("node"), bits), "node").mapInArrow(_extend(threshold), "node binary, key long")
        longer, n_longer = work.stage_counted(longer, "longer", tasks_for(docs.sparkSession, n_open, SETS_PER_TASK))
        known = with_maybe(faces, ["node"], membership(held, ["node"], bits), "maybe", bits).filter("maybe").drop("maybe")
        met = _meeting(together(longer, n_longer)).join(_sorted(known.dropDuplicates(["node"])), "node").select("node", "size", "there", "bits", "key")
        rows, n_rows = work.stage_counted(met, "level", tasks_for(docs.sparkSession, n_longer))
        work.drop(paths, longer)

    met = alike_rows[0]
    for more in alike_rows[1:]:
        met = met.unionByName(more)
    met = met.select(F.concat(F.lit("n"), F.hex("node")).alias("u"), F.concat(F.lit("k"), F.col("key").cast("string")).alias("v"))
    grid_of = work.stage(
        components(met).filter(F.col("node").startswith("n")).select(F.unhex(F.substring("node", 2, 32)).alias("node"), F.col("root").alias("grid")), "grids", few
    )
    cells = work.stage(_cells(grid_of, _sets_of(described, grid_of.select("node"), bits), threshold, block), "cells")

    pairs = candidates[0]
    for more in candidates[1:]:
        pairs = pairs.unionByName(more)
    # Pairs within a grid have been compared there.
    grid = lambda s: grid_of.select(F.col("node").alias(s), F.col("grid").alias(f"{s}_grid"))
    apart = ~F.coalesce(F.col("a_grid") == F.col("b_grid"), F.lit(False))
    pairs, n_pairs = work.stage_counted(
        pairs.distinct().join(_sorted(grid("a")), "a", "left").join(_sorted(grid("b")), "b", "left").filter(apart).select("a", "b"), "pairs"
    )
    work.drop(*kept)
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    # A pair names two sets at most, and brings both.
    checked = tasks_for(docs.sparkSession, 2 * n_pairs, SETS_PER_TASK)
    sets = work.stage(_sets_of(described, wanted, bits), "wanted", checked)
    side = lambda s: sets.select(F.col("node").alias(s), F.col("tokens").alias(f"{s}_tokens"))
    links = work.stage(
        pairs.join(_sorted(side("a")), "a").join(_sorted(side("b")), "b").select("a", "b", "a_tokens", "b_tokens")
        .mapInArrow(_verify(threshold), "a binary, b binary"),
        "links",
        checked,
    )
    work.drop(pairs, sets)

    counts = (
        links.select(F.col("a").alias("node")).union(links.select("b")).withColumn("links", F.lit(1).cast("long"))
        .union(cells.select("node", "links"))
        .groupBy("node").agg(F.sum("links").alias("n_links"))
    )
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(cells.select(F.col("node").alias("u"), F.col("to").alias("v")))
    roots = work.stage(components(edges), "roots", few)
    head = F.min(F.struct(F.col("rep_id").isNull(), F.col("rep_id"), F.col("node"))).alias("head")
    heads = work.stage(roots.join(_sorted(nodes), "node").groupBy("root").agg(head).select("root", "head.rep_id", "head.node"), "heads", few)
    classed = roots.join(_sorted(heads.select("root", F.col("rep_id").alias("class_id"), F.col("node").alias("head"))), "root")
    known = work.stage(
        nodes.join(_sorted(counts), "node", "left").join(_sorted(classed.drop("root")), "node", "left")
        .select(
            "node", "rep_id", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("class_id", "rep_id").alias("class_id"), F.coalesce("head", "node").alias("head"),
        ),
        "known",
        few,
    )
    placed = work.stage(members, "members")
    work.drop(described)
    work.drop(cells, links, roots, heads, grid_of)
    return placed.join(_sorted(known), "node")


def _sorted(df: DataFrame) -> DataFrame:
    """A side that grows with the documents: joined by sort-merge at every size, never sent through the driver."""
    return df.hint("merge")


def _pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """Candidates (a, b), a < b, from small buckets."""
    cols = ("node", "size", "there", "bits")
    a = rows.select("key", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = rows.select("key", *[F.col(c).alias(f"b_{c}") for c in cols])
    either = "bit_count(a_there | b_there)"
    agree = "bit_count(a_there & b_there & ~(a_bits ^ b_bits))"
    near = F.expr(
        f"a_node < b_node AND least(a_size, b_size) >= {threshold} * greatest(a_size, b_size) - 1e-9 AND "
        f"(least(a_size, b_size) < {SKETCH_FROM} OR {agree} >= {SKETCH_SHARE} * {either})"
    )
    return a.join(_sorted(b), "key").filter(near).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def _alike(large: DataFrame, last: bool) -> DataFrame:
    """(key, dense): whether the members of a bucket are alike on average.

    If p of the members have bit k of the sketch, two of them agree there with
    chance p^2 + (1-p)^2; the mean over bits is (1 + similarity) / 2.
    """
    ones = [F.expr(f"sum((bits >> {k}) & 1) AS o{k}") for k in range(64)]
    per_key = large.groupBy("key").agg(F.count(F.lit(1)).alias("m"), *ones)
    # One expression as text: built from columns it takes the driver seconds.
    agree = " + ".join(f"pow(o{k} / m, 2) + pow(1 - o{k} / m, 2)" for k in range(64))
    return per_key.select("key", (F.lit(last) | (F.expr(f"2 * ({agree}) / 64 - 1") >= ALIKE)).alias("dense"))


def _meeting(rows: DataFrame) -> DataFrame:
    """The rows whose key occurs again (or may, by the filter), each node once for a key."""
    again = membership(rows.groupBy("key").count().filter("count > 1"), ["key"], KEY_BITS)
    met = with_maybe(rows, ["key"], again, "maybe", KEY_BITS).filter("maybe").drop("maybe")
    return met.dropDuplicates(["node", "key"])


def _cells(grid_of: DataFrame, sets: DataFrame, threshold: float, block: int) -> DataFrame:
    """(node, links, to) from each cell of the grids; (i, j), i <= j, holds blocks i and j of a grid."""
    sizes = grid_of.groupBy("grid").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = grid_of.join(_sorted(sizes), "grid").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).join(_sorted(sets), "node")
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return (
        other.select("grid", "node", "tokens", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .groupBy("grid", "i", "j")
        .applyInPandas(_compare_cell(threshold), "node binary, links long, to binary")
    )


@F.pandas_udf(T.BinaryType())
def _node(text: pd.Series) -> pd.Series:
    return text.map(lambda t: _digest(shingles(t)))


def _same(doc_id, node):
    """What rows equal in id and shingles share; a null id is left out, so it is equal to itself only."""
    return F.concat_ws(":", doc_id, F.hex(node)).alias("same")


def drop_near_duplicates(docs: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """One row of each class (the one with the least doc_id), with all columns of ``docs``.

    Rows that are surely alone in their class pass as they are; only others shuffle,
    once. No condition of the match but its key is on the digests: one that reached the
    scan would compute them twice there, with a second Python worker in each task.
    """
    work = Workings("jaccard")
    grouped = _classes(docs).filter("copies > 1 OR n_links > 0")
    stays = (F.col("node") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))
    grouped = work.stage(grouped.select("doc_id", "node", stays.alias("stays")).distinct(), "grouped")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = with_maybe(rows, ["doc_id"], membership(grouped.select("doc_id"), ["doc_id"], bits), "maybe", bits)
    suspects = marked.filter("maybe").select("row", _same(F.col("doc_id"), _node("text"))).dropDuplicates(["same"])
    known = grouped.select(_same(F.col("doc_id"), F.col("node")), "stays")
    stay = suspects.join(_sorted(known), "same", "left").filter("coalesce(stays, true)")
    return marked.filter("NOT maybe").select("row.*").unionByName(stay.select("row.*"))


@query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))
