"""The bar store: bars written once as Parquet partitioned by market and month.

Queries that read bars more than once read this snapshot instead of re-deriving
bars from ticks in every branch: the tick scan and its aggregation run once,
later scans are column-pruned and partition-pruned on ``market``.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import BAR_COLUMNS, BAR_SCHEMA, require_columns
from tidemark.sources.stats import StoreStats

MONTH = "bar_month"
SUMMARY_COLUMNS = ["close", "volume", "nbr_trades"]
STORED_SCHEMA = T.StructType([*BAR_SCHEMA.fields, T.StructField(MONTH, T.IntegerType())])


def month_of(column: str = "datetime") -> Column:
    """yyyymm of epoch milliseconds."""
    day = F.timestamp_millis(column)
    return (F.year(day) * 100 + F.month(day)).cast("int")


def write_bars(bars: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Overwrite (S4) or append (S6) bars, partitioned by market and month and
    range-clustered on (market, datetime): a file spans a stretch of one market's
    time, so time filters skip files and row groups."""
    (bars.select(*BAR_COLUMNS).withColumn(MONTH, month_of())
     .repartitionByRange("market", "datetime").sortWithinPartitions("market", "datetime")
     .write.mode(mode).partitionBy("market", MONTH).parquet(path))


def bar_stats(spark: SparkSession, path: str) -> StoreStats:
    """Moments and file index kept beside the store (``update`` after a write)."""
    return StoreStats(spark, path, STORED_SCHEMA, MONTH, ["market"], SUMMARY_COLUMNS, "datetime")


def unique_bars(bars: DataFrame) -> DataFrame:
    """One row per (market, datetime): of copies that differ the last closed one
    (``close_time``), then the one of the most trades, then of the greatest
    values; whole rows, never mixed columns. Copies collapse before the shuffle."""
    cols = [c for c in bars.columns if c not in ("market", "datetime")]
    rank = F.struct(*[F.col(c) for c in dict.fromkeys([*(c for c in ("close_time", "nbr_trades") if c in cols), *cols])])
    best = F.max_by(F.struct(*cols), rank).alias("_r")
    return bars.groupBy("market", "datetime").agg(best).select("market", "datetime", "_r.*").select(*bars.columns)


def append_bars(bars: DataFrame, path: str) -> None:
    """S6 without the double-append hazard: only (market, datetime) keys not yet
    stored are appended (left anti join on the key), and duplicates inside the
    new batch are reduced first. Only the batch's markets and months are read
    from the store."""
    new = unique_bars(bars)
    try:
        have = bars.sparkSession.read.schema(STORED_SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        have = None                                 # first write: nothing stored yet
    if have is not None:
        span = new.agg(F.collect_set("market").alias("markets"), F.min("datetime").alias("lo"), F.max("datetime").alias("hi"),
                       F.min(month_of()).alias("first"), F.max(month_of()).alias("last")).first()     # one row
        if span["lo"] is None:
            return
        have = have.where(F.col("market").isin(span["markets"]) & F.col(MONTH).between(span["first"], span["last"])
                          & F.col("datetime").between(span["lo"], span["hi"]))
        # the anti join reads the stored keys before the append commits
        new = new.join(have.select("market", "datetime"), on=["market", "datetime"], how="left_anti")
    write_bars(new, path, mode="append")
    stats = bar_stats(bars.sparkSession, path)
    if have is not None and stats.tables.versions():             # kept for this store: the batch's months change
        stats.update([m for m in range(span["first"], span["last"] + 1) if 1 <= m % 100 <= 12])


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Check the stored files' own schema first (P9: an older writer
    without calendar columns fails here, naming them, instead of reading NULLs),
    then read with the declared schema."""
    require_columns(spark.read.parquet(path), BAR_COLUMNS, "bar store")
    return spark.read.schema(STORED_SCHEMA).parquet(path).select(*BAR_COLUMNS)


def time_slice(spark: SparkSession, path: str, lo: int, hi: int) -> DataFrame:
    """Bars with ``lo <= datetime <= hi`` (epoch ms): other months are not listed,
    other files skipped by their statistics."""
    first, last = (int(f"{t:%Y%m}") for t in (datetime.fromtimestamp(x / 1000, timezone.utc) for x in (lo, hi)))
    return (spark.read.schema(STORED_SCHEMA).parquet(path)
            .where(F.col(MONTH).between(first, last) & F.col("datetime").between(lo, hi)).select(*BAR_COLUMNS))
