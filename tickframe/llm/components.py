"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import stored


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) for every node of the undirected links (a, b); root is the smallest node of its component.

    Each round hangs the neighbours of every node on its smallest neighbour (large star, then small star)
    and is written to the shared folder; rounds end when the link set no longer changes. Links of a node are only ever
    aggregated or joined on it, so a hub is split like any skewed key.
    """
    edges = stored(links.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), name)
    mark = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b"))
        edges = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), name)
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_000_007).alias("h")).first()
        if seen == mark:
            break
        mark = seen
    out = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return out.union(out.select("root", "root").distinct())
