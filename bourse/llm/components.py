"""Connected components of a table of links, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.tables import stored


def _attach_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least neighbour of u or u itself. The minima are a written table, so that the join shuffles
    both sides and a hub's edges can be split over tasks."""
    least = stored(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "component-minima")
    return edges.join(least, "u")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node of the component.

    The number of rounds grows with the logarithm of the longest chain. Stars centred on their least node need none.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "component-edges")
    for _ in range(most_rounds):
        # Each larger end has one smaller neighbour, and no smaller end is itself a larger end: a forest of stars.
        loose = edges.groupBy("u").count().where("count > 1").limit(1).count() or edges.join(
            edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count()
        if not loose:
            break
        small = _attach_least(edges)
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").union(
            small.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(edges, "component-edges")
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _attach_least(both).where("v > u")
        edges = stored(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "component-edges")
    else:
        raise RuntimeError("components did not settle")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
