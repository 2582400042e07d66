"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(a, b)`` longs -> ``(node, root)`` for every node of an edge; equal roots: same component.

    Each round maps a node to the least of itself and its neighbours in a hashed order, and replaces the edges by those
    between the images.  The hashed order shrinks the graph by a constant share a round whatever the ids look like.
    Hot nodes only meet partial minima and joins that adaptive execution can split.  The levels are then composed.
    """

    def rank(c):
        return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))

    levels, turn = [], 0
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), f"{label}-edges")
    while turn == 0 or edges.head(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(rank("b")).alias("_m")).select(
            F.col("a").alias("node"), F.when(F.col("_m") < F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("v")), F.col("_m.v")).otherwise(F.col("a")).alias("parent")
        )
        least = stored(least, f"{label}-level{turn}")
        levels.append(least)
        edges = (
            edges.join(least.select(F.col("node").alias("a"), F.col("parent").alias("_a")), "a")
            .join(least.select(F.col("node").alias("b"), F.col("parent").alias("_b")), "b")
            .where("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
        )
        edges = stored(edges, f"{label}-edges")
        turn += 1
    roots = levels.pop().select("node", F.col("parent").alias("root"))
    while levels:
        below = levels.pop()
        up = roots.select(F.col("node").alias("parent"), "root")
        roots = stored(below.join(up, "parent", "left").select("node", F.coalesce("root", "parent").alias("root")), f"{label}-roots")
    return roots
