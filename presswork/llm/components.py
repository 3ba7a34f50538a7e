"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the least node of its neighbourhood."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; the component is its smallest node.

    Large-star and small-star steps alternate until every child has one parent, which is nobody's
    child: the edges are then stars around the smallest nodes. Edges are written after each pair of
    steps, so a lost executor costs one step, and only whether they are stars comes to the driver.
    Loops, repeated edges and null ends add nothing; no edges give no rows.
    """
    current = materialize(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("a is not null and b is not null and a <> b")
        .distinct(),
        "edges",
    )
    while True:
        following = materialize(_small_star(_large_star(current)), "edges")
        ends = following.select("u", F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
            following.select(F.col("v"), F.lit(0), F.lit(1))
        )
        roles = ends.groupBy("u").agg(F.sum("child").alias("up"), F.max("parent").alias("down"))
        if roles.filter("up > 1 or (up > 0 and down > 0)").isEmpty():
            break
        current = following
    nodes = following.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = following.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
