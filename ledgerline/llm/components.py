"""Connected components by alternating large and small stars, all on Spark.

Every round hangs neighbours on the least node they can see, so the number of
rounds grows with the logarithm of the component sizes. A star is one written
table, and what tells whether a round changed anything is observed while it is
written. Joins are sort-merge at every size, so that adaptive execution can split
the edges of a hub and nothing that grows with the edges goes through the driver.
Stars on few edges are one task each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.llm.common import Workings, tasks_for, together

MOST_ROUNDS = 60


def _written(work: Workings, edges: DataFrame, tasks: int | None = None) -> tuple[DataFrame, tuple]:
    """The edges stored, with their number and a sum of hashes that tells sets of edges apart."""
    seen = Observation()
    facts = (F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hashes"))
    stored = work.stage(edges.filter("u != v").distinct().observe(seen, *facts), "edges", tasks)
    return stored, (seen.get["n"], seen.get["hashes"])


def _star(edges: DataFrame, n: int, large: bool) -> DataFrame:
    """One star operation on ``n`` edges (u, v), u != v."""
    if large:
        sides = together(edges.union(edges.select("v", "u")), 2 * n)
    else:
        sides = together(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), n)
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = sides.join(least.hint("merge"), "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # The least neighbour itself stands for the edge from u to it.
    return joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v): root is the least node of its component."""
    work = Workings("components")
    edges, now = _written(work, edges)
    before = None
    for _ in range(MOST_ROUNDS):
        if now == before or not now[0]:
            break
        before = now
        for large in (True, False):
            # A star has no more edges than it was made from.
            after, now = _written(work, _star(edges, now[0], large), tasks_for(edges.sparkSession, now[0]))
            work.drop(edges)
            edges = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v")).distinct()
