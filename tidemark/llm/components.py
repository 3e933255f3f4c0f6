"""Connected components of a table of edges, by alternating star steps.

Each step makes every node point to the least node it has seen: the large star moves
larger neighbours, the small star the node and its smaller ones. Steps end when the
edges no longer change, which takes a number of rounds that grows with the logarithm
of the size. A hub is a skewed key of a join only, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.col("b") % 1_000_003).alias("s")).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of its component, for every node with an edge (`a`, `b`, both long)."""
    edges = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-edges"
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        edges = stage(small.where("a <> b").distinct(), "component-edges")
        before, state = state, _state(edges)
        if before == state:
            break
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
