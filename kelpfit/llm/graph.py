"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.llm.common import stored


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """node, root for every node of the edges (a, b); root is the smallest node of its component.

    Each round points every node at its smallest neighbour, follows the pointers a
    few steps, and renames both ends of every edge; edges inside a component vanish,
    so their number shrinks by a factor. Nothing is collected, and a node with very
    many edges is only ever a key of partial sums and of joins that can be split. A round
    stores its pointers and the edges that are left, in files by their number; the
    pointers of all rounds are followed at the end. ``most`` bounds the number of edges, if known.
    """
    edges = stored(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", most)
    rounds = []
    while True:
        left = edges.count()
        if not left and rounds:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("up"))
        hop = up.select(F.col("node").alias("up"), F.col("up").alias("next"))
        far = up.join(hop, "up").select("node", F.col("next").alias("up"))
        far = stored(far.join(hop, "up").select("node", F.col("next").alias("up")), "pointers", 2 * left)
        rounds.append(far)
        if not left:
            break
        ends = far.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        others = far.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        edges = stored(edges.join(ends, "a").join(others, "b").where("ua <> ub").select(
            F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges", left)
    roots = rounds[0].withColumnRenamed("up", "root")
    for far in rounds[1:]:
        moved = far.select(F.col("node").alias("root"), "up")
        roots = roots.join(moved, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return roots
