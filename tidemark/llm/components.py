"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (a long, b long) → (node, root), root the smallest node of the
    component; nodes without links do not appear.

    Each round writes its links to the shared folder (no growing lineage); a
    round's links are never more than the last one's nodes and links. Minima
    are formed map side first and a node's links are never gathered in one row.
    """
    pairs = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links", "snappy")
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node links to the node's smallest neighbour
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: a node's smaller neighbours link to the smallest of them
        large = stored(large.where("a <> b").distinct(), "large-star", "snappy")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        small = stored(small, "small-star", "snappy")
        # done when every node has one smaller neighbour and that has none
        again = small.count() != small.select("a").distinct().count() or not small.join(small.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()
        pairs = small
        if not again:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
