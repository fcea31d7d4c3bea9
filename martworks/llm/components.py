"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is an aggregation and a join over links, so no component is ever gathered; the number of steps grows with the
logarithm of the longest chain. Each step is written to the shared folder, which cuts lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.session import release, written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in `links` (a, b; longs). `component` is the smallest node of the component. Repeated
    links and links of a node with itself are no harm; links with a null are left out."""
    plain = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = plain.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # A link leads from the larger to the smaller node.
    current = written(_directed(plain), "links")
    before = None
    count = current.count()
    while True:
        previous, current = current, written(_small_star(_large_star(current)), "links", at_most=2 * count)
        release(previous)
        # Both steps only lower the ends of links; once their sums stay, every node points at its component's smallest.
        state = current.agg(F.count(F.lit(1)), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.col("a").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, count = state, state[0]
    found = current.groupBy("a").agg(F.min("b").alias("b"))
    return nodes.join(found, nodes["node"] == found["a"], "left").select(
        "node", F.coalesce("b", "node").alias("component"))


def _directed(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's smallest neighbour, or the node itself if it is smaller."""
    both = links.select(F.inline(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("low"))
    joined = both.filter("b > a").join(least, F.col("a") == F.col("u"))
    return joined.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked with the node's smallest neighbour."""
    least = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("low"))
    joined = links.join(least, F.col("a") == F.col("u"))
    ends = F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct(F.col("a"), F.col("low").alias("b")))
    return joined.select(F.inline(ends)).filter("a <> b").distinct()
