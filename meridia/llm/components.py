"""Distributed union-find: connected components by alternating star contraction.

Large-star and small-star steps (Kiveris et al., 2014) hang every node under the
smallest node of its component. Each step is a grouped minimum and an equi-join,
so no component meets in one task and the driver sees only two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _with_minimum(edges: DataFrame) -> DataFrame:
    """(u, v, m): m is the smallest of u and its neighbours v."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least.hint("merge"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Expects u > v in every row, as _large_star leaves them."""
    found = _with_minimum(edges)
    below = found.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.union(found.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Label every node of ``edges`` with the smallest node it can reach.

    Returns ``node``, ``component`` for each node that has an edge to another
    one. Null ends and loops link nothing; repeated edges count once; an empty
    table gives an empty result.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (a.isNotNull() & b.isNotNull()).alias("ok")).where("ok AND u <> v").select("u", "v").distinct()
    edges = materialise(edges, "edges")
    state = None
    while True:
        seen = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (seen.n, seen.x) == state or seen.n == 0:
            break
        state = (seen.n, seen.x)
        before, edges = edges, materialise(_small_star(_large_star(edges)), "stars", 2 * seen.n)
        discard(before)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
