"""Table contracts: column lists, StructTypes and the required-column check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values that the data contract shares with the reference pipeline.
# Raw kline reply: positional field names, in reply order (12 positions).
KLINE_FIELDS = ["datetime", "open", "high", "low", "close", "volume",
                "close_time", "qav", "nbr_trades", "taker_base_vol",
                "taker_quote_vol", "unused_field"]
# Per-market feature columns of the wide matrix, in matrix order.
FEATURE_COLUMNS = ["close", "open", "high", "low", "rolling_avg_7d",
                   "nbr_trades", "volume"]
# Calendar columns carried by every bar and by the wide matrix.
CALENDAR_COLUMNS = ["day", "month", "year", "day_of_week"]

# Exact price/volume arithmetic: averages go through a decimal sum.
PRICE_DECIMAL = "decimal(28,8)"

BAR_SCHEMA = T.StructType([
    T.StructField("market", T.StringType(), False),
    T.StructField("datetime", T.LongType(), False),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("close_time", T.LongType()),
    T.StructField("qav", T.DoubleType()),
    T.StructField("nbr_trades", T.LongType()),
    T.StructField("taker_base_vol", T.DoubleType()),
    T.StructField("taker_quote_vol", T.DoubleType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
])
BAR_COLUMNS = [f.name for f in BAR_SCHEMA.fields]

# Long stream table `market` (one row per received kline message).
MARKET_TABLE_SCHEMA = T.StructType([
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_date", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("start_timestamp", T.LongType()),
    T.StructField("close_timestamp", T.LongType()),
    T.StructField("qav", T.DoubleType()),
    T.StructField("nbr_trades", T.IntegerType()),
    T.StructField("taker_base_vol", T.DoubleType()),
    T.StructField("taker_quote_vol", T.DoubleType()),
    T.StructField("symbol", T.StringType()),
])

# Stream kline message: `k` is read as a string map because its keys differ
# only in case (t/T, v/V, q/Q), which a struct cannot hold unambiguously.
KLINE_MESSAGE_SCHEMA = T.StructType([
    T.StructField("E", T.LongType()),
    T.StructField("s", T.StringType()),
    T.StructField("k", T.MapType(T.StringType(), T.StringType())),
])

BALANCE_REPLY_SCHEMA = T.StructType([
    T.StructField("account", T.LongType()),
    T.StructField("balances", T.ArrayType(T.StructType([
        T.StructField("asset", T.StringType()),
        T.StructField("free", T.StringType()),
        T.StructField("locked", T.StringType()),
    ]))),
])

TRADES_REPLY_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("orderId", T.LongType()),
    T.StructField("price", T.StringType()),
    T.StructField("qty", T.StringType()),
    T.StructField("quoteQty", T.StringType()),
    T.StructField("commission", T.StringType()),
    T.StructField("commissionAsset", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("isBuyer", T.BooleanType()),
    T.StructField("isMaker", T.BooleanType()),
    T.StructField("isBestMatch", T.BooleanType()),
]))

MARKET_LIST_SCHEMA = T.StructType([
    T.StructField("serverTime", T.LongType()),
    T.StructField("symbols", T.ArrayType(T.StructType([
        T.StructField("symbol", T.StringType()),
        T.StructField("status", T.StringType()),
    ]))),
])

PRICE_SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("Currency", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("price", T.StringType()),
])


class SchemaContractError(ValueError):
    """A frame lacks columns its consumer needs (raised before any job runs)."""


def require_columns(df: DataFrame, columns, what: str = "frame") -> DataFrame:
    """Fail at plan time, naming every missing column, instead of deep in a job."""
    have = set(df.columns)
    missing = [c for c in columns if c not in have]
    if missing:
        raise SchemaContractError(f"{what} is missing required columns {missing}; has {sorted(have)}")
    return df
