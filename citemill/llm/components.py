"""Connected components of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citemill.shared import materialise


def _nearest(edges: DataFrame, ends: list[tuple[str, str]]) -> DataFrame:
    """``u, v, low``: every edge seen from the given ends, with the smallest of ``u`` and its neighbours."""
    both = None
    for u, v in ends:
        part = edges.select(F.col(u).alias("u"), F.col(v).alias("v"))
        both = part if both is None else both.unionByName(part)
    # One small row per node is shuffled before the edges meet it, so a node with
    # very many edges is a skewed join, which Spark splits, and not one window.
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("low"))
    return both.join(low, "u")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is either a root or has one edge, to a root: one shuffle of nodes, summed before it."""
    up = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = up.unionByName(down).groupBy("node").agg((F.sum("up") + F.max("down")).alias("roles"))
    return nodes.filter("roles > 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links``; the root is the smallest node of its component.

    Nodes may be of any ordered type. Every round is written to the shared
    folder, so no round is computed again when an executor is lost. The rounds end
    when every component is a star; stars from an earlier call take none.
    """
    edges = links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = materialise(edges, "links")
    while not _all_stars(edges):
        # Larger neighbours of a node move to the smallest one.
        large = _nearest(edges, [("u", "v"), ("v", "u")]).filter("v > u")
        large = large.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # Smaller neighbours and the node itself do the same.
        small = _nearest(large, [("u", "v")])
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            small.select("u", F.col("low").alias("v"))
        )
        edges = materialise(small.filter("u <> v").distinct(), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
