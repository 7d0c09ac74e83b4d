"""Serving: average the wide table over the last days into one request row (A1, A2,
F6, F7, F10), then score it and decide (F8, M2)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import FEATURE_COLUMNS, PRICE_DECIMAL

MS_PER_DAY = 86_400_000


def serving_window(as_of: dt.date, days: int = 7) -> tuple[int, int, dt.date]:
    """(start_ms, end_ms, end_day): end = midnight after ``as_of``, start = ``days``-1
    days before it; both ends inclusive (a 7-day window spans 6 days + 1 ms)."""
    end_day = as_of + dt.timedelta(days=1)
    start_day = end_day - dt.timedelta(days=days - 1)
    epoch = dt.date(1970, 1, 1)
    return ((start_day - epoch).days * MS_PER_DAY, (end_day - epoch).days * MS_PER_DAY, end_day)


def _mean(c):
    return (F.sum(c.cast(PRICE_DECIMAL)).cast("double") / F.count(c))


def window_averages(wide: DataFrame, markets: list[str], as_of: dt.date, days: int = 7,
                    key: str = "datetime") -> DataFrame:
    """One row: per market the mean of each feature column over the window, where
    ``close`` ignores zeros (the insert default) and the others average them in;
    only rows with at least one non-zero close count. Calendar columns describe
    the day after ``as_of`` (Monday = 0). Partial aggregates, one tiny final."""
    start_ms, end_ms, end_day = serving_window(as_of, days)
    any_close = reduce(lambda a, b: a | b, [F.col(f"{m}_close") != F.lit(0) for m in markets])
    rows = wide.filter(F.col(key).between(start_ms, end_ms) & any_close)
    aggs = []
    for m in markets:
        for c in FEATURE_COLUMNS:
            x = F.col(f"{m}_{c}")
            if c == "close":
                x = F.when(x != F.lit(0), x)
            aggs.append(_mean(x).alias(f"{m}_{c}"))
    cal = [F.lit(end_day.day).alias("day"), F.lit(end_day.month).alias("month"),
           F.lit(end_day.year).alias("year"), F.lit(end_day.weekday()).alias("day_of_week")]
    return rows.agg(*aggs).select(*cal, *[f"{m}_{c}" for m in markets for c in FEATURE_COLUMNS])


def naive_prediction(matrix: DataFrame, features: list[str], out: str = "prediction") -> DataFrame:
    """Mean of the feature markets' trailing averages (a SQL-checkable stand-in score)."""
    s = reduce(lambda a, b: a + b, [F.col(f"{m}_rolling_avg_7d") for m in features])
    return matrix.withColumn(out, s / F.lit(float(len(features))))


def daily_requests(wide: DataFrame, markets: list[str], days: int = 7, key: str = "datetime") -> DataFrame:
    """The serving average for every day at once: each wide row is copied to the
    (at most ``days``) request days whose window holds it, then one groupBy per
    request day. Copies are bounded by ``days``; partial aggregation keeps the
    shuffle at one row per (task, day)."""
    t = F.col(key)
    lo = F.ceil(t / F.lit(MS_PER_DAY)).cast("bigint")
    hi = F.floor(t / F.lit(MS_PER_DAY)).cast("bigint") + F.lit(days - 1)
    any_close = reduce(lambda a, b: a | b, [F.col(f"{m}_close") != F.lit(0) for m in markets])
    rows = wide.filter(any_close).withColumn("_end_day", F.explode(F.sequence(lo, hi)))
    aggs = []
    for m in markets:
        for c in FEATURE_COLUMNS:
            x = F.col(f"{m}_{c}")
            if c == "close":
                x = F.when(x != F.lit(0), x)
            aggs.append(_mean(x).alias(f"{m}_{c}"))
    g = rows.groupBy("_end_day").agg(*aggs)
    end = F.date_add(F.lit("1970-01-01").cast("date"), F.col("_end_day").cast("int"))
    return g.select((F.col("_end_day") * F.lit(MS_PER_DAY)).alias("request_day_ms"),
                    F.dayofmonth(end).alias("day"), F.month(end).alias("month"), F.year(end).alias("year"),
                    F.weekday(end).alias("day_of_week"),
                    *[f"{m}_{c}" for m in markets for c in FEATURE_COLUMNS])
