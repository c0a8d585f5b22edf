"""Connected components of a graph held as a table of links: distributed union-find.

Each round is a large-star and a small-star step: links are moved to the smallest
known neighbour.  Every step is a grouped minimum (combined before its shuffle)
and an equi-join that adaptive execution may split, so a node with very many
links is never gathered in one task.  Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import discard, stored


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest of the node and its neighbours."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) between long ids -> (node, component), component being the smallest id.

    Only nodes with a link to another node appear.  Nulls and self-links are ignored;
    repeated and reversed links count once.  No links give an empty table.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    now = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        before, now = now, stored(_small_star(_large_star(now)), "links")
        discard(before)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
