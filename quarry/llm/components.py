"""Connected components of an edge table, by contraction.

Every round each node joins its neighbour with the most edges (ties by a
hash that changes with the round), edges are rewritten between the joined
nodes, and loops and repeats go. Stars collapse in one round and paths
shrink by a constant factor, so the number of rounds grows with the
logarithm of the longest path. All steps are joins and aggregations; the
driver sees only whether edges are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is the
    smallest node of the component. Nodes are longs; loops are ignored."""
    left = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    parents: list[DataFrame] = []
    salt = 0
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = both.groupBy("a").agg(F.count("*").alias("deg"))
        rank = F.struct(F.col("deg"), F.xxhash64(F.lit(salt), "node").alias("h"), "node")
        ranked = degree.select(F.col("a").alias("node"), "deg").select("node", rank.alias("r"))
        near = both.join(ranked.select(F.col("node").alias("b"), "r"), "b").select("a", "r")
        own = ranked.select(F.col("node").alias("a"), "r")
        parent = written(
            near.unionAll(own).groupBy("a").agg(F.max("r").alias("r")).select(F.col("a").alias("node"), F.col("r.node").alias("to")),
            "parents",
        )
        parents.append(parent)
        pa_ = parent.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        pb_ = parent.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        moved = left.join(pa_, "a").join(pb_, "b").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        left = written(moved.where("a <> b").distinct(), "edges")
        salt += 1
    if not parents:
        return left.select(F.col("a").alias("node"), F.col("a").alias("label"))
    roots = parents[0].select("node", F.col("to").alias("root"))
    for parent in parents[1:]:
        step = parent.select(F.col("node").alias("root"), "to")
        roots = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    roots = written(roots, "roots")
    # The root is itself a node of the component, so the smallest node over the root's members is the label.
    labels = roots.groupBy("root").agg(F.min("node").alias("label"))
    return roots.join(labels, "root").select("node", "label")
