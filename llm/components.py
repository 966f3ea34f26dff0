"""Connected components by alternating large-star and small-star rounds.

Edges stay in tables; each round joins them with the least neighbour of each vertex,
an aggregate that combines before its shuffle, and writes the result to shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str, rounds: int = 60) -> DataFrame:
    """(node, component): the least vertex that each vertex of an edge (u, v) can reach.

    Vertices without an edge to another do not occur in the result.  Null ends and
    loops are left out.
    """
    state = scratch.put(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u != v").distinct(), f"{name}-0")
    sign = None
    for k in range(1, rounds + 1):
        state = scratch.put(_small_star(_large_star(state)), f"{name}-{k}")
        new = state.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        scratch.drop(f"{name}-{k - 1}")
        if sign == new:
            break
        sign = new
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
