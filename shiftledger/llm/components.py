"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b; longs) as node and root, the smallest node of its component.

    Each round hangs the larger neighbours of every node on its smallest
    neighbour, then the smaller ones, until nothing moves.  A hub's
    neighbours are counted before the shuffle and split by adaptive execution in
    the joins.  A root, and a node
    without links, has no row as a node.
    """
    forward = links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = written(forward.distinct(), "links")
    state = None
    while True:
        size = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(size) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(size)
        both = edges.select("u", "v").unionByName(
            edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
