"""Connected components of an edge table by alternating large and small stars (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm import common

MAX_ROUNDS = 60


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on a node."""
    twice = edges.groupBy("u").count().where("count > 1").select("u")
    chained = edges.select("u").join(edges.select(F.col("v").alias("u")), "u", "left_semi")
    return twice.unionByName(chained).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, root being the smallest node of its component; roots too.

    ``edges`` has columns u and v of one orderable type; direction, repeats and loops don't matter; rows with a null are left out. A round
    hangs each node's larger neighbours on its smallest neighbour, then its smaller neighbours; rounds
    go with the logarithm of the longest chain. Minima are summed before they are shuffled, so a node with very many edges is no
    hot spot there; the joins that follow have one row a node on one side.
    """
    edges = edges.where("u is not null and v is not null and u != v")
    edges = common.written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _are_stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = common.written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = common.written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
