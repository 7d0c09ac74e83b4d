"""Exact regression splits by prefix sums over sorted distinct values (ML8, ML9).

For every (node, feature) rows are first reduced to (value, count, sum of labels)
— map side, so repeated values cost a row per task — and running sums over the
sorted distinct values give the reduction of squared error at every cut between two
neighbours:

    SL^2 / nL + SR^2 / nR - S^2 / n

The best cut of a node has the largest reduction; ties go to the earlier feature,
then the smaller threshold. Thresholds are midpoints. Label sums are decimal, so
the result does not depend on the order of rows.

The window of one (node, feature) holds its distinct values: use few-valued
features, or bin others first (``boosting.cut_points``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import PRICE_DECIMAL


def best_splits(rows: DataFrame, features: list[str], label: str, node: str = "node") -> DataFrame:
    """One row for each node that can be split: node, feature, threshold, n_left, n_right, mean_left, mean_right, gain."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("at"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for k, c in enumerate(features)]))
    values = (rows.select(F.col(node).alias("node"), F.col(label).cast(PRICE_DECIMAL).alias("y"), pairs.alias("p"))
              .groupBy("node", "p.at", "p.feature", "p.value").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")))
    ordered = Window.partitionBy("node", "at").orderBy("value")
    whole = Window.partitionBy("node", "at")
    run = values.select("node", "at", "feature", "value", F.lead("value").over(ordered).alias("next"), F.sum("n").over(ordered).alias("n_left"),
                        F.sum("s").over(ordered).cast("double").alias("s_left"), F.sum("n").over(whole).alias("n"), F.sum("s").over(whole).cast("double").alias("s"))
    n_right, s_right = F.col("n") - F.col("n_left"), F.col("s") - F.col("s_left")
    cuts = run.filter(F.col("next").isNotNull()).select(
        "node", "at", "feature", ((F.col("value") + F.col("next")) / 2).alias("threshold"), "n_left", n_right.alias("n_right"),
        (F.col("s_left") / F.col("n_left")).alias("mean_left"), (s_right / n_right).alias("mean_right"),
        (F.col("s_left") * F.col("s_left") / F.col("n_left") + s_right * s_right / n_right - F.col("s") * F.col("s") / F.col("n")).alias("gain"))
    best = F.min_by(F.struct("feature", "threshold", "n_left", "n_right", "mean_left", "mean_right", "gain"), F.struct(-F.col("gain"), "at", "threshold"))
    return cuts.groupBy("node").agg(best.alias("b")).select("node", "b.*")


def grow(rows: DataFrame, features: list[str], label: str, depth: int) -> list[dict]:
    """The splits of a tree of ``depth`` levels: node 1 is the root, node k has
    children 2k and 2k + 1. One aggregate for each level, a row back for each node."""
    splits: list[dict] = []
    for level in range(depth):
        at = rows.withColumn("node", node_of(splits))
        own = [r.asDict() for r in best_splits(at.filter(F.col("node") >= 1 << level), features, label).collect() if r["gain"] > 0]
        if not own:
            break
        splits += own
    return sorted(splits, key=lambda s: s["node"])


def node_of(splits: list[dict]) -> Column:
    """The node at which a row stands after ``splits``."""
    node = F.lit(1)
    for level in range(max((s["node"] for s in splits), default=0).bit_length()):
        at = node
        for s in splits:
            if s["node"] >> level == 1:
                node = F.when(at == s["node"], F.lit(2 * s["node"]) + (F.col(s["feature"]) > s["threshold"]).cast("int")).otherwise(node)
    return node


def predict(splits: list[dict], mean: float) -> Column:
    """Leaf means of a grown tree; ``mean`` where it has no split."""
    node, out = node_of(splits), F.lit(mean)
    for s in splits:
        for child, value in ((2 * s["node"], s["mean_left"]), (2 * s["node"] + 1, s["mean_right"])):
            out = F.when(node == child, F.lit(value)).otherwise(out)
    return out
