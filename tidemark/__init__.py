"""tidemark: market time-series analytics expressed as Spark DataFrame plans.

Bars keyed by (market, datetime) are decoded from raw replies, cleaned,
averaged over trailing frames, pivoted into one wide feature row per
timestamp, scored by MLlib models and served; the same operators run on
Structured Streaming micro-batches.

The main entry points are re-exported here; every function takes and
returns DataFrames (or Columns).
"""

from tidemark.functions.pricing import buy_signal, limit_price
from tidemark.functions.timecols import calendar_columns, day_of_week, epoch_ms, ms_to_ntz
from tidemark.operators.chunks import chunk_plan
from tidemark.operators.cleaning import clean_bars, drop_null_columns
from tidemark.operators.matrix import (close_time_matrix, driver_semi, feature_matrix,
                                       feature_matrix_joins, wide_enrich)
from tidemark.operators.serving import daily_requests, window_averages
from tidemark.operators.windows import point_mean, trailing_mean_range, trailing_mean_rows
from tidemark.session import build_session, cluster_conf
from tidemark.sources.bars import bars_from_events, bars_from_ticks
from tidemark.sources.replies import (decode_kline_arrays, decode_kline_messages, decode_market_list,
                                      decode_price_snapshots, decode_trades)
from tidemark.sources.store import append_bars, read_bars, write_bars

__version__ = "0.1.0"

__all__ = [
    "append_bars", "bars_from_events", "bars_from_ticks", "build_session", "buy_signal",
    "calendar_columns", "chunk_plan", "clean_bars", "close_time_matrix", "cluster_conf",
    "daily_requests", "day_of_week", "decode_kline_arrays", "decode_kline_messages",
    "decode_market_list", "decode_price_snapshots", "decode_trades", "driver_semi",
    "drop_null_columns", "epoch_ms", "feature_matrix", "feature_matrix_joins", "limit_price",
    "ms_to_ntz", "point_mean", "read_bars", "trailing_mean_range", "trailing_mean_rows",
    "wide_enrich", "window_averages", "write_bars",
]
