"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def contractions(edges: DataFrame, jumps: int = 2) -> list[DataFrame]:
    """Maps (node, parent), one a round, that lead every node of the undirected edges (a, b) to one node of its component.

    In each round every node moves to the neighbour with the least hash, salted by the round, if that is less than its
    own, and on from there `jumps` times over twice the way; the edges move with their ends, and those within one node
    vanish. Whatever the graph, a round leaves half of its nodes on average (on a chain a third), so both the rounds and
    the sizes of the maps fall off geometrically.
    """
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        rank = lambda c, n=len(maps): F.struct(F.xxhash64(F.lit(n), F.col(c)).alias("hash"), F.col(c).alias("node"))
        both = edges.select("a", "b").union(edges.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("best")).select("node", F.least("best", rank("node"))["node"].alias("parent"))
        for _ in range(jumps):
            parent = written(parent, "parents")
            above = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            parent = parent.join(above, "parent").select("node", F.col("above").alias("parent"))
        parent = written(parent, "parents")
        maps.append(parent)
        a, b = (parent.select(F.col("node").alias(x), F.col("parent").alias(f"p{x}")) for x in ("a", "b"))
        moved = edges.join(a, "a").join(b, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = written(moved.distinct(), "edges")
    return maps


def connected_components(edges: DataFrame, jumps: int = 2) -> DataFrame:
    """(node, component) for each node of the undirected edges (a, b): the smallest node it is connected with.

    Self-loops and repeated edges change nothing; no edges give no rows.
    """
    maps = contractions(edges, jumps)
    if not maps:
        return written(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0), "components")
    roots = maps[-1]
    for earlier in maps[-2::-1]:  # from the smallest map to the whole one: each is a fraction of the next
        onward = roots.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        roots = written(earlier.join(onward, "parent", "left").select("node", F.coalesce("root", "parent").alias("parent")), "roots")
    least = roots.groupBy("parent").agg(F.min("node").alias("component"))
    return written(roots.join(least, "parent").select("node", "component"), "components")
