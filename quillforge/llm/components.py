"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.session import stage


def connected(edges: DataFrame) -> DataFrame:
    """node, root of every node of ``edges`` (a, b); the root is the component's smallest node.

    Alternating stars: each round links every larger neighbour of a node, then every
    smaller one, to the node's smallest. Rounds are few, logarithmic in the longest
    path in practice; each is written out, so none repeats the one before. A node's
    neighbours are never gathered: its smallest is a sum before the shuffle, and a
    join, which can split a node with many, brings it to them.
    """
    now = stage(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        # Both ends see each other; a node's smallest neighbour takes its larger ones.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a != b").distinct()
        # Larger to smaller only; the smallest takes the others and the node.
        smaller = large.groupBy("a").agg(F.min("b").alias("least"))
        joined = large.join(smaller, "a")
        small = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(smaller.select("a", F.col("least").alias("b")))
        after = stage(small.where("a != b").distinct())
        state = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            roots = after.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        now, before = after, state
