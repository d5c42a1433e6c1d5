"""Connected components over an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..tables import discard, written


def _nearest(edges: DataFrame) -> DataFrame:
    """Each vertex u with the smallest of itself and its neighbours v. Partial sums before the shuffle make hubs harmless."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges u > v to (u, m): m is the smallest vertex at v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return edges.join(_nearest(both).withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _nearest(low)
    return low.join(near, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))


def _step(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The edges as a table, and a mark of their set, which is counted while they are written."""
    seen = Observation()
    table = written(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), name)
    return table, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, v) pairs of longs to (vertex, component): component is the smallest vertex that can be reached.

    Only vertices with an edge to another one come out; loops and rows with a null are ignored; repeated pairs count once.
    The number of rounds grows with the logarithm of a component's diameter; beyond `rounds` it raises.
    """
    now, seen = _step(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    for _ in range(rounds):
        if not seen[0]:
            break
        after, mark = _step(_small_star(_large_star(now)).where("u <> v").distinct(), "stars")
        discard(now)
        now = after
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
