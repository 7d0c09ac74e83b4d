"""Wide rows: one row per timestamp holding several markets' columns.

The reference builds the matrix with a five-way self join on ``datetime``. With
(market, datetime) unique, the same rows come from ONE ``groupBy(datetime)``
with a conditional aggregate per (market, column) and a presence filter: one
shuffle of the bar table instead of five sort-merge joins over four filtered
copies of the same windowed plan. The join form is kept for comparison.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timecols import calendar_columns, ms_to_ntz
from tidemark.operators.windows import DEFAULT_CHUNK_MS, trailing_mean_range, trailing_mean_rows
from tidemark.schemas import CALENDAR_COLUMNS, FEATURE_COLUMNS

ROLLING = "rolling_avg_7d"


def prefixed(market: str, column: str) -> str:
    """Wide column name: lower-cased market + '_' + column."""
    return f"{market.lower()}_{column}"


def _pick(market: str, column: str):
    """Value of ``column`` on the (unique) row of ``market`` in the group."""
    return F.max(F.when(F.col("market") == F.lit(market), F.col(column)))


def _present(market: str):
    return F.max(F.when(F.col("market") == F.lit(market), F.lit(1))).isNotNull()


def with_rolling_rows(bars: DataFrame, rows: int = 7, out: str = ROLLING,
                      chunk_width: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """W1/W2 on bars: trailing mean of close over ``rows`` rows per market."""
    return trailing_mean_rows(bars, "market", "datetime", "close", rows, out, chunk_width)


def feature_matrix(bars: DataFrame, target: str, features: list[str], rows: int = 7,
                   chunk_width: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """J1 one-pass: datetime, <target>_close, calendar (from the target row), then
    for each feature market its 7 columns; only timestamps where all markets exist."""
    markets = [target] + list(features)
    need = ["market", "datetime", "close", "open", "high", "low", "nbr_trades", "volume",
            *CALENDAR_COLUMNS]
    b = bars.filter(F.col("market").isin(markets)).select(*need)
    w = with_rolling_rows(b, rows, ROLLING, chunk_width)
    aggs = [_pick(target, "close").alias(f"{target.lower()}_close")]
    aggs += [_pick(target, c).alias(c) for c in CALENDAR_COLUMNS]
    for m in features:
        for c in FEATURE_COLUMNS:
            e = _pick(m, c)
            aggs.append((e.cast("double") if c == "nbr_trades" else e).alias(prefixed(m, c)))
    flags = [_present(m).alias(f"_has_{i}") for i, m in enumerate(markets)]
    g = w.groupBy("datetime").agg(*aggs, *flags)
    keep = reduce(lambda a, b2: a & b2, [F.col(f"_has_{i}") for i in range(len(markets))])
    return g.filter(keep).drop(*[f"_has_{i}" for i in range(len(markets))])


def feature_matrix_joins(bars: DataFrame, target: str, features: list[str], rows: int = 7,
                         chunk_width: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """J1 as the reference writes it: window, then target ⋈ each market on datetime."""
    need = ["market", "datetime", "close", "open", "high", "low", "nbr_trades", "volume"]
    merged = with_rolling_rows(bars.filter(F.col("market").isin(list(features))).select(*need),
                               rows, ROLLING, chunk_width)
    out = bars.filter(F.col("market") == target).select(
        "datetime", F.col("close").alias(f"{target.lower()}_close"), *CALENDAR_COLUMNS)
    for m in features:
        side = merged.filter(F.col("market") == m).select(
            "datetime", *[(F.col(c).cast("double") if c == "nbr_trades" else F.col(c)).alias(prefixed(m, c))
                          for c in FEATURE_COLUMNS])
        out = out.join(side, on="datetime", how="inner")
    return out


def close_time_matrix(bars: DataFrame, target: str, features: list[str], rows: int = 8,
                      chunk_width: int = DEFAULT_CHUNK_MS) -> DataFrame:
    """J2 + A5 + O1: trailing ``rows``-row mean per feature market joined with the
    target close on close_time, distinct, sorted by close_time."""
    markets = [target] + list(features)
    b = bars.filter(F.col("market").isin(markets)).select("market", "datetime", "close_time", "close")
    w = with_rolling_rows(b, rows, "average", chunk_width)
    aggs = [_pick(m, "average").alias(prefixed(m, "average")) for m in features]
    aggs.append(_pick(target, "close").alias(prefixed(target, "close_price")))
    flags = [_present(m).alias(f"_has_{i}") for i, m in enumerate(markets)]
    g = w.groupBy("close_time").agg(*aggs, *flags)
    keep = reduce(lambda a, b2: a & b2, [F.col(f"_has_{i}") for i in range(len(markets))])
    return (g.filter(keep).drop(*[f"_has_{i}" for i in range(len(markets))])
            .distinct().orderBy("close_time"))


def wide_enrich(long: DataFrame, driver: str, others: list[str], key: str = "datetime",
                time_col: str | None = None, monday: int = 0) -> DataFrame:
    """A wide row exists only where the driver market has a row at ``key``;
    other markets attach when present at the same key, else 0 (the insert
    defaults). Calendar columns come from the key time, Monday = ``monday``.

    ``long`` needs market, key and the FEATURE_COLUMNS (rolling_avg_7d included).
    """
    markets = [driver] + list(others)
    aggs = []
    for m in markets:
        for c in FEATURE_COLUMNS:
            e = _pick(m, c)
            if m != driver:
                e = F.coalesce(e, F.lit(0))
            aggs.append((e.cast("int") if c == "nbr_trades" else e.cast("double")).alias(prefixed(m, c)))
    g = (long.filter(F.col("market").isin(markets)).groupBy(key)
         .agg(_present(driver).alias("_has_driver"), *aggs)
         .filter(F.col("_has_driver")).drop("_has_driver"))
    year, month, day, dow = calendar_columns(ms_to_ntz(time_col or key), monday)
    return g.select(F.col(key), day, month, year, dow,
                    *[prefixed(m, c) for m in markets for c in FEATURE_COLUMNS])


def with_rolling_range(long: DataFrame, key: str = "datetime", length: int = 7 * 86_400_000,
                       out: str = ROLLING, chunk_width: int | None = None) -> DataFrame:
    """W3 on a long bar/market table: trailing ``length`` ms RANGE mean of close."""
    return trailing_mean_range(long, "market", key, "close", length, out, chunk_width)


def driver_semi(long: DataFrame, driver: str, key: str = "datetime") -> DataFrame:
    """Rows of the other markets whose key exists among the driver's rows."""
    drv = long.filter(F.col("market") == driver).select(key).distinct()
    return long.filter(F.col("market") != driver).join(drv, on=key, how="left_semi")
