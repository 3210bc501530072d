"""Connected components of a table of links, by star operations on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotwise.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris and others, 2014): every node
    links its neighbours to the smallest of them, until nothing changes. A step is two
    aggregations and joins by node, so a node with very many neighbours is summed before
    the shuffle and its join is split by adaptive execution. Each step is written to the
    shared folder. Nothing but two sums per step reaches the driver.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = written(links, "links")
    before = None
    while True:
        links = written(_small_star(_large_star(links)), "links")
        # The links are a forest of stars once their number and end points stand still.
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
