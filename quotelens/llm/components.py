"""Connected components of a link table by alternating star contraction.

Links stay in DataFrames: each round moves every node's larger neighbours, then its smaller ones,
to the least node it knows. A round is a few narrow shuffles and is written to the shared folder,
so no lineage grows and a lost executor costs one round. Hub nodes are no hot keys: the least
neighbour comes from a partial aggregate and is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelens.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): every neighbour v of u with the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _least(down)
    return (found.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(found.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end that is no larger end itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with a link to another; component: its least reachable node.

    Rows with a null end or equal ends are no links. An empty table gives an empty result."""
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    while not _are_stars(edges):
        edges = materialize(_small_star(_large_star(edges)), "star")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
