"""Exploration operators: distinct, counts, first/latest rows, summaries, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import PRICE_DECIMAL


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def count_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """Deterministic head: total order on ``order`` then limit (TakeOrderedAndProject:
    per-partition top-n, one small merge)."""
    return df.orderBy(*order).limit(n)


def latest_per_key(df: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The latest ``n`` rows per key. Spark inserts a partial WindowGroupLimit
    before the shuffle, so each task forwards at most ``n`` rows per key — a hot
    key does not move its history."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def first_by_key(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Value on the earliest row of each key (``.first()`` after a sort), as min_by."""
    return df.groupBy(key).agg(F.min(order).alias(f"first_{order}"),
                               F.min_by(value, order).alias(out))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def summary(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """count/mean/stddev/min/max per key and column, typed (describe() returns strings).

    One aggregate with partial combine; the result is unpivoted to
    (key, column, count, mean, stddev, min, max). Means use a decimal sum.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"),
                 F.sum(F.col(c).cast(PRICE_DECIMAL)).cast("double").alias(f"{c}__s"),
                 F.round(F.stddev_samp(x), 6).alias(f"{c}__sd"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    g = df.groupBy(key).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("count"),
        (F.col(f"{c}__s") / F.col(f"{c}__n")).alias("mean"),
        F.col(f"{c}__sd").alias("stddev"),
        F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")) for c in columns]))
    return g.select(key, rows.alias("r")).select(key, "r.*")
