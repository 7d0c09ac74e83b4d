"""Cleaning: required-value row filter, non-zero close, de-duplication, and the
column-dropping null rule (F2, F3, Q3, Q10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.store import unique_bars

REQUIRED_BAR_VALUES = ["market", "datetime", "open", "high", "low", "close", "volume",
                       "close_time", "nbr_trades"]


def clean_bars(bars: DataFrame, required=REQUIRED_BAR_VALUES) -> DataFrame:
    """Rows with every required value, a non-zero close, and one row per (market, datetime).

    Re-running an ingest appends the same bars, a correction appends another row
    of the key: ``unique_bars`` leaves one whole row (an aggregate with map-side
    combine, so copies collapse before the shuffle). ``close <> 0`` also drops
    NULL closes, which the required-value filter has already removed.
    """
    keep = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return unique_bars(bars.filter(keep & (F.col("close") != F.lit(0))))


def null_counts(df: DataFrame) -> DataFrame:
    """One pass, one row: number of NULLs per column (partial + final aggregate)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def kept_columns(df: DataFrame) -> DataFrame:
    """Names of the columns that contain no NULL, as rows (column_name, position).

    The per-column null counts are aggregated in Spark, then unpivoted; no data
    row reaches the driver.
    """
    counts = null_counts(df)
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"),
                 F.col(c).alias("nulls")) for i, c in enumerate(df.columns)])).alias("s"))
    return (stacked.filter(F.col("s.nulls") == 0)
            .select(F.col("s.column_name").alias("column_name"),
                    F.col("s.position").cast("int").alias("position")))


def drop_null_columns(df: DataFrame) -> DataFrame:
    """pandas ``dropna(axis=1, how='any')``: drop every column holding a NULL.

    The decision is one aggregate row (width = number of columns) read on the
    driver, like a schema; the data itself is only projected.
    """
    row = null_counts(df).first()
    return df.select(*[c for c in df.columns if row[c] == 0])
