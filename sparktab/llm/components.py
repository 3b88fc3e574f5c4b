"""Connected components of an edge table by alternating stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import cut

ROUNDS = 100


def _min_neighbour(arcs: DataFrame) -> DataFrame:
    return arcs.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node that has an edge; component is its smallest reachable node.

    Each round hangs all neighbours on the smallest one (first the larger neighbours, then the smaller ones), so rounds
    grow with the logarithm of the longest path. Minima are pre-aggregated, so a hub costs no more than its edges, and each
    round's edges are checkpointed. Loops, repeated and reversed edges and nulls have no effect.
    """
    named = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("full"))
    stars = cut(named.where("full AND u <> v").select("u", "v").distinct())
    if stars.isEmpty():
        return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    for _ in range(ROUNDS):
        arcs = stars.union(stars.select("v", "u"))
        least = _min_neighbour(arcs).select("u", F.least("u", "m").alias("m"))
        large = arcs.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        joined = large.join(_min_neighbour(large), "u")
        small = joined.select("u", F.col("m").alias("v")).union(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        stars = cut(small.distinct())
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select("v", "v").distinct())
        before = now
    raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
