"""Connected components of a graph that is given by its links, without collecting anything.

Alternating large and small stars: every node is linked to the smallest node that it knows, until nothing changes.
Each step is written to the shared folder. Grouping is by minimum with a partial step, so a hub needs no list of its
neighbours; joins on a hub's key are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to the smallest one around it."""
    both = _both_ways(links)
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them. Links lead from large to small."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).unionByName(moved).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node of its component."""
    current = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .distinct(), "links")
    mark = None
    while True:
        current = stored(_small_star(stored(_large_star(current), "large-star")), "small-star")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
