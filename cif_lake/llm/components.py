"""Connected components of an edge table by alternating star contractions; no node sees more than sums and minima of its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cif_lake.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each neighbour below a node, and the node, are linked to the least of them. Expects a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)`` of longs; the root is the least node that can be reached.

    Edges to itself and nulls are dropped, repeated edges count once; no edges give no rows. The edges of a round are checkpointed,
    and the loop ends when a round leaves them as they were (their number and the sum of their hashes).
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = None
    while True:
        edges = checkpointed(_small_star(_large_star(edges)))
        hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
        now = tuple(edges.agg(F.count("*"), F.sum(hashed)).first())
        if now == state or not now[0]:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
