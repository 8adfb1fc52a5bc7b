"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.session import written


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every child hangs below one root and no root is a child."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("below")).union(edges.select("b", F.lit(0)))
    of_node = ends.groupBy("node").agg(F.sum("below").alias("below"), F.min("below").alias("least"))
    return of_node.filter("below > 1 OR (below = 1 AND least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``links`` (a, b), itself included.

    Large-star and small-star steps: every step hangs a node's neighbours below the smallest of them, so
    the depth of the graph shrinks geometrically and no neighbourhood is ever gathered in one task: the
    minima are combined map-side and joined back. Each round is stored, which cuts the lineage.
    Nodes with a null end and links of a node to itself are left out.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a > b").distinct(), "links")
    while not _is_forest_of_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        large = (both.join(least, "a").filter("b > a AND b != root")
                 .select(F.col("b").alias("a"), F.col("root").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = (large.join(least, "a").filter("b != root")
                 .select(F.col("b").alias("a"), F.col("root").alias("b"))
                 .union(least.select("a", F.col("root").alias("b"))).distinct())
        edges = written(small, "links")
    roots = edges.select("a", "b")
    return roots.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
