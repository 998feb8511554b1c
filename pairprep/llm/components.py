"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairprep.sources.scratch import stage


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free digest, to see when a step changes nothing."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def components(edges: DataFrame) -> DataFrame:
    """(u, v) long pairs to (node, root): root is the smallest node that can be reached.

    Every step only groups by a node with a combinable minimum, writes that and joins it back, so a
    node with very many neighbours is split by adaptive execution (it cannot split a join that
    stands right behind an aggregate); every round is written to the shared folder. Rows of one node, loops and repeats are allowed; nodes without an edge do not appear.
    """
    high, low = F.greatest("u", "v"), F.least("u", "v")
    now = stage(edges.where("u <> v").select(high.alias("u"), low.alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        large = stage(large, "edges")
        parent = stage(large.groupBy("u").agg(F.min("v").alias("m")), "parent")
        moved = large.join(parent, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(moved.union(parent.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now, before = after, state
        state = _state(now)
        if state == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
