"""Connected components of links, by large and small stars in joins.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every step is a grouped
minimum and an equi-join between two written tables, so that the grouped part is combined before
its shuffle and the join can be split at a hub with many links. The tables are in the shared
folder: a lost executor costs the running step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skilltide.session import saved


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: link greater neighbours to the least of the neighbourhood. Small: the lesser ones."""
    near = _both_ways(edges) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = saved(
        near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "components-least"
    )
    joined = near.join(least, "a")
    if large:
        linked = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return saved(linked.filter(F.col("a") != F.col("b")).distinct(), "components-links")


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a root, and no root has one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node in ``edges(a, b)``: the least node it is linked with."""
    edges = saved(
        edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "components-links",
    )
    while not _stars(edges):
        edges = _star(_star(edges, large=True), large=False)
    return saved(
        edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
            edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
        ),
        "components",
    )
