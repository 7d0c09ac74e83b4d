"""Request plan for paged history fetches.

[start, end) of each symbol is cut into windows of about 1000 bars: the window
length in days is (whole days of the span) / (bars in the span / 1000). Window
i starts at start + i·(length + gap) and ends at min(start + length, end).
``gap`` = 0 tiles the span exactly; the historic fetch loop skipped one day
after every window (gap = 1 day). Windows are generated per symbol row with
``sequence`` + ``explode`` — no cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timecols import MS_PER_DAY, floor_div

# Milliseconds per bar of each supported interval, bars per call.
INTERVAL_MS = {"1m": 60_000, "1h": 3_600_000}
BARS_PER_CALL = 1000


def chunk_plan(spans: DataFrame, interval: str = "1h", gap_ms: int = 0) -> DataFrame:
    """spans(symbol, start_ms, end_ms) → (symbol, chunk, start_ms, end_ms, startTime, endTime)."""
    rec_ms = INTERVAL_MS[interval]
    total = F.col("end_ms") - F.col("start_ms")
    days = floor_div(total, MS_PER_DAY)
    period = F.floor(days.cast("double") * F.lit(float(MS_PER_DAY))
                     * F.lit(float(rec_ms * BARS_PER_CALL)) / total.cast("double")).cast("bigint")
    # a span under one whole day has no day count to divide: one window covers it
    period = F.when(period > 0, period).otherwise(total)
    p = spans.withColumn("_period", period).withColumn("_step", F.col("_period") + F.lit(gap_ms))
    n = F.ceil((F.col("end_ms") - F.col("start_ms")) / F.col("_step")).cast("bigint")
    p = p.filter(F.col("_period") > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
    start = F.col("start_ms") + F.col("chunk") * F.col("_step")
    end = F.least(start + F.col("_period"), F.col("end_ms"))
    return p.select("symbol", F.col("chunk").cast("int").alias("chunk"), start.alias("window_start_ms"),
                    end.alias("window_end_ms")).select(
        "symbol", "chunk", "window_start_ms", "window_end_ms",
        F.col("window_start_ms").cast("string").alias("startTime"),
        F.col("window_end_ms").cast("string").alias("endTime"))


def spans_from_ticks(ticks: DataFrame, symbol: str, t_us: str) -> DataFrame:
    """Per symbol: [midnight of first tick, midnight after last tick) in ms."""
    day_us = MS_PER_DAY * 1000
    return (ticks.groupBy(F.col(symbol).alias("symbol"))
            .agg(F.min(t_us).alias("_lo"), F.max(t_us).alias("_hi"))
            .select("symbol", (floor_div("_lo", day_us) * F.lit(MS_PER_DAY)).alias("start_ms"),
                    ((floor_div("_hi", day_us) + 1) * F.lit(MS_PER_DAY)).alias("end_ms")))
