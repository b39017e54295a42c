"""Connected components of a link table, without any vertex's links in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _large_star(links: DataFrame) -> DataFrame:
    """Links (u, v) with u > v; every larger neighbour of a vertex moves to the least one around it."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    return both.filter("v > u").join(least, "u").select(
        F.col("v").alias("u"), F.least("u", "least").alias("v")
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and the vertex itself, moves to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    moved = links.join(least, "u").filter("v > least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, v): for every vertex that has a link and isn't the least of its component, that least one.

    `links` has two columns `u` and `v` of one orderable type. Large and small star steps alternate
    until nothing changes; minima are combined before they are exchanged. Every round is written to
    the shared folder. An empty table gives an empty result.
    """
    current = common.written(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    state = None
    for _ in range(rounds):
        following = current.agg(
            F.count(F.lit(1)), F.expr("coalesce(sum(cast(xxhash64(u, v) AS decimal(38, 0))), 0)")
        ).first()
        if following == state or not following[0]:
            return current
        state = following
        current = common.written(_small_star(_large_star(current)), "links")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
