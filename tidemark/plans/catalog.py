"""Registered queries: name → (spark, sf_dir) → DataFrame.

Every query reads the given tables (or what Spark derives from them) whole.
Hourly bars are the default source; ``entry`` uses daily bars at sf0.001.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.pricing import buy_signal, limit_price
from tidemark.functions.timecols import (calendar_columns, day_of_week, epoch_ms, epoch_us,
                                        floor_div, ms_to_ntz, serving_bounds)
from tidemark.ml import features as mf
from tidemark.ml import models as mm
from tidemark.ml import splits as sp
from tidemark.ml.boosting import HistogramBoosting
from tidemark.operators import chunks as ch
from tidemark.operators import cleaning as cl
from tidemark.operators import explore as ex
from tidemark.operators import matrix as mx
from tidemark.operators import serving as sv
from tidemark.operators.windows import point_mean, trailing_mean_range, trailing_mean_rows
from tidemark.schemas import BAR_COLUMNS, FEATURE_COLUMNS, require_columns
from tidemark.session import materialize, scratch_path
from tidemark.sources import paged as pg
from tidemark.sources import replies as rp
from tidemark.sources import stats, store
from tidemark.sources.bars import FEATURE_MARKETS, TARGET_MARKET, bars_from_events, ticks_from_events
from tidemark.sources.stats import StoreStats
from tidemark.sources.tables import read_with_schema, table
from tidemark.streaming import finalize as fin
from tidemark.streaming import klines as sk

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WEEK_MS = 7 * 86_400_000


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


_STORES: dict[tuple, str] = {}


def stored_once(spark: SparkSession, sf_dir: str, what: str, write: Callable[[str], None]) -> str:
    """Path of what ``write`` made of a dataset, once per session, in the shared folder."""
    key = (spark.conf.get("spark.app.id", "app"), sf_dir.rstrip("/"), what)
    if key not in _STORES:
        path = scratch_path(spark, what)
        write(path)
        _STORES[key] = path
    return _STORES[key]


def bar_store_path(spark: SparkSession, sf_dir: str, bucket="hour") -> str:
    """The bar store of a dataset: derived from events and written once per session
    to the shared folder (the ingest step), with its statistics; later plans scan it."""
    def write(path: str) -> None:
        store.write_bars(bars_from_events(table(spark, sf_dir, "events"), bucket), path)
        store.bar_stats(spark, path).update()
    return stored_once(spark, sf_dir, f"bars-{bucket}", write)


def bar_store(spark: SparkSession, sf_dir: str, bucket="hour") -> DataFrame:
    return store.read_bars(spark, bar_store_path(spark, sf_dir, bucket))


def bars(spark: SparkSession, sf_dir: str, bucket="hour", stored: bool = False) -> DataFrame:
    """Bars derived from events; ``stored`` reads them from the bar store
    instead (for plans that read bars in several branches)."""
    if stored:
        return bar_store(spark, sf_dir, bucket)
    return bars_from_events(table(spark, sf_dir, "events"), bucket)


@register("bar_scan")
def q_bar_scan(spark, sf_dir):
    """A scan of the stored bar table with its declared schema."""
    return bars(spark, sf_dir, stored=True).select(*BAR_COLUMNS)


@register("market_feature_matrix")
def q_market_feature_matrix(spark, sf_dir):
    return mx.feature_matrix(bars(spark, sf_dir, stored=True), TARGET_MARKET, FEATURE_MARKETS, rows=7)


@register("market_feature_matrix_joins")
def q_market_feature_matrix_joins(spark, sf_dir):
    return mx.feature_matrix_joins(bars(spark, sf_dir, stored=True), TARGET_MARKET, FEATURE_MARKETS, rows=7)


@register("close_time_matrix")
def q_close_time_matrix(spark, sf_dir):
    return mx.close_time_matrix(bars(spark, sf_dir, stored=True), TARGET_MARKET, FEATURE_MARKETS, rows=8)


@register("trailing_avg_rows7")
def q_trailing_avg_rows7(spark, sf_dir):
    b = bars(spark, sf_dir, stored=True).filter(F.col("market").isin(FEATURE_MARKETS))
    return trailing_mean_rows(b.select("market", "datetime", "close_time", "close"),
                              "market", "datetime", "close", 7, "rolling_avg_7d")


@register("trailing_avg_rows8")
def q_trailing_avg_rows8(spark, sf_dir):
    b = bars(spark, sf_dir, stored=True).filter(F.col("market").isin(FEATURE_MARKETS))
    return trailing_mean_rows(b.select("market", "datetime", "close_time", "close"),
                              "market", "datetime", "close", 8, "average")


@register("trailing_avg_range7d")
def q_trailing_avg_range7d(spark, sf_dir):
    b = bars(spark, sf_dir, stored=True).select("market", "datetime", "close")
    return trailing_mean_range(b, "market", "datetime", "close", WEEK_MS, "rolling_avg_range7d")


@register("tick_avg_range7d")
def q_tick_avg_range7d(spark, sf_dir):
    """W3 on raw ticks: frames of thousands of rows."""
    ev = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("market"), epoch_ms("ts").alias("t_ms"), "value")
    # chunks far narrower than the frame: a hot market spreads over many tasks
    return trailing_mean_range(ev, "market", "t_ms", "value", WEEK_MS, "avg_range7d", WEEK_MS // 50)


@register("point_avg")
def q_point_avg(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("market"),
        (floor_div(epoch_us("ts"), 60_000_000) * F.lit(60_000)).alias("event_timestamp"),
        F.col("value").alias("close"))
    return point_mean(ev, "market", "event_timestamp", "close", "avg_close")


# --- scans, slices, exploration (S5, F5, A3-A7, A11, O2, O3, U1) -------------

@register("market_slice")
def q_market_slice(spark, sf_dir):
    """F5 on the store: the equality on the partition column prunes directories."""
    return bars(spark, sf_dir, stored=True).filter(F.col("market") == TARGET_MARKET)


@register("distinct_markets")
def q_distinct_markets(spark, sf_dir):
    return ex.distinct_values(bars(spark, sf_dir), "market")


@register("bars_per_market")
def q_bars_per_market(spark, sf_dir):
    return ex.count_by(bars(spark, sf_dir), "market", out="n_bars")


@register("count_by_key")
def q_count_by_key(spark, sf_dir):
    return ex.count_by(bars(spark, sf_dir), "datetime", out="n_rows")


@register("first_bars")
def q_first_bars(spark, sf_dir):
    return ex.first_rows(bars(spark, sf_dir).select("market", "datetime", "open", "close", "volume"),
                         ["datetime", "market"], 20)


@register("latest_bars")
def q_latest_bars(spark, sf_dir):
    """O3: the newest rows of each market, from the files that the store's index names."""
    newest = store.bar_stats(spark, bar_store_path(spark, sf_dir)).latest("market", 24)
    return ex.latest_per_key(newest.select("market", "datetime", "close", "nbr_trades"), "market", "datetime", 24)


@register("first_close_time")
def q_first_close_time(spark, sf_dir):
    return ex.first_by_key(bars(spark, sf_dir), "market", "datetime", "close_time", "first_close_time")


@register("union_bars")
def q_union_bars(spark, sf_dir):
    b = bars(spark, sf_dir, stored=True)
    return ex.union_all([b.filter(F.col("market") == m) for m in [TARGET_MARKET] + FEATURE_MARKETS])


@register("clean_bars")
def q_clean_bars(spark, sf_dir):
    """Bars of a repeated ingest, with corrected copies (one more trade), zero and NULL closes among them."""
    b = bars(spark, sf_dir, stored=True)
    hour = F.pmod(floor_div("datetime", 3_600_000), F.lit(24))
    corrected = b.where(hour == 5).withColumn("close", F.col("close") + 1).withColumn("nbr_trades", F.col("nbr_trades") + 1)
    zero = b.where(hour == 7).withColumn("close", F.lit(0.0)).withColumn("datetime", F.col("datetime") + 1)
    missing = b.where(hour == 9).withColumn("close", F.lit(None).cast("double")).withColumn("datetime", F.col("datetime") + 1)
    return cl.clean_bars(b.unionByName(b).unionByName(corrected).unionByName(zero).unionByName(missing))


@register("append_bars")
def q_append_bars(spark, sf_dir):
    """The ingest run again over a store that holds a part of it leaves each bar once."""
    b = bars(spark, sf_dir, stored=True)
    path = scratch_path(spark, "append")
    store.append_bars(b.where(F.pmod(floor_div("datetime", 3_600_000), F.lit(3)) < 2), path)
    store.append_bars(b, path)
    store.append_bars(b.unionByName(b), path)
    return store.read_bars(spark, path)


@register("drop_null_columns")
def q_drop_null_columns(spark, sf_dir):
    return cl.kept_columns(bars(spark, sf_dir))


@register("calendar_features")
def q_calendar_features(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", *calendar_columns("ts"),
                     day_of_week("ts", monday=0).alias("day_of_week0"))


@register("epoch_roundtrip")
def q_epoch_roundtrip(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ms = epoch_ms("ts")
    return ev.select("event_id", ms.alias("epoch_ms"), ms_to_ntz(ms).alias("ts_ms"))


@register("feature_summary")
def q_feature_summary(spark, sf_dir):
    """A7 from the store's moments: a merge of a row for each market, column and month."""
    return stats.summary(store.bar_stats(spark, bar_store_path(spark, sf_dir)).moments(), "market")


@register("feature_summary_scan")
def q_feature_summary_scan(spark, sf_dir):
    """A7 by one aggregate over the rows."""
    return ex.summary(bars(spark, sf_dir), "market", ["close", "volume", "nbr_trades"])


# --- wide table joins (J3, J4) ----------------------------------------------

WIDE_DRIVER = FEATURE_MARKETS[0]
WIDE_OTHERS = FEATURE_MARKETS[1:]


def long_with_range_avg(spark, sf_dir, lo_ms: int | None = None, hi_ms: int | None = None) -> DataFrame:
    """Feature-market bars with their 7-day RANGE mean. When only rows in
    [lo_ms, hi_ms] are wanted, the scan is cut to [lo_ms - 7 days, hi_ms]
    BELOW the window (Catalyst cannot push a filter through a window on a
    non-partition column); exact, as no frame reaches further back."""
    b = bars(spark, sf_dir, stored=True).filter(F.col("market").isin(FEATURE_MARKETS))
    if lo_ms is not None:
        b = b.filter(F.col("datetime") >= F.lit(lo_ms - WEEK_MS))
    if hi_ms is not None:
        b = b.filter(F.col("datetime") <= F.lit(hi_ms))
    out = mx.with_rolling_range(b.select("market", "datetime", "close", "open", "high", "low",
                                         "nbr_trades", "volume"))
    if lo_ms is not None:
        out = out.filter(F.col("datetime") >= F.lit(lo_ms))
    return out


@register("driver_left_enrich")
def q_driver_left_enrich(spark, sf_dir):
    return mx.wide_enrich(long_with_range_avg(spark, sf_dir), WIDE_DRIVER, WIDE_OTHERS)


@register("driver_semi")
def q_driver_semi(spark, sf_dir):
    b = bars(spark, sf_dir, stored=True).filter(F.col("market").isin(FEATURE_MARKETS))
    return mx.driver_semi(b.select("market", "datetime", "close"), WIDE_DRIVER)


# --- raw replies: decode and plan (S1, S2, S7, S15, S16, F1, F9, N3, G1) -----

BALANCE_ASSETS = ["purchase", "signup"]
SYMBOL_PREFIX = "p"
FAILING_SYMBOL = "error"


@register("kline_array_decode")
def q_kline_array_decode(spark, sf_dir):
    good, _ = rp.decode_kline_arrays(rp.kline_array_replies(bars(spark, sf_dir, stored=True)))
    return good


def landed_pages(spark, sf_dir) -> str:
    """Reply pages of the dataset, fetched in two runs: the markets one after the other."""
    def write(root: str) -> None:
        replies = rp.kline_array_replies(bars(spark, sf_dir, stored=True))
        pg.land_pages(replies.filter(F.col("symbol") == TARGET_MARKET), root, 0)
        pg.land_pages(replies.filter(F.col("symbol") != TARGET_MARKET), root, 1)
    return stored_once(spark, sf_dir, "pages", write)


@register("paged_replies")
def q_paged_replies(spark, sf_dir):
    """The landed pages through the data source, decoded."""
    return rp.decode_kline_arrays(pg.read_replies(spark, landed_pages(spark, sf_dir)))[0]


@register("paged_week")
def q_paged_week(spark, sf_dir):
    """The last 7 days from the pages that touch them."""
    last = bars(spark, sf_dir, stored=True).agg(F.max("datetime").alias("m")).first()["m"]
    return pg.bars_between(spark, landed_pages(spark, sf_dir), last - WEEK_MS, last)


@register("paged_stream")
def q_paged_stream(spark, sf_dir):
    """K1: a stream over the pages that stops after the first landing and resumes at its offset."""
    root, out = landed_pages(spark, sf_dir), scratch_path(spark, "paged-stream")
    first = scratch_path(spark, "pages-arriving")
    replies = pg.read_replies(spark, root)
    for landing, own in ((0, F.col("symbol") == TARGET_MARKET), (1, F.col("symbol") != TARGET_MARKET)):
        pg.land_pages(replies.filter(own), first, landing)
        query = (pg.stream_replies(spark, first).writeStream.format("parquet").option("checkpointLocation", f"{out}-checkpoint")
                 .trigger(availableNow=True).start(out))
        sk.run_until_done(query)
    return rp.decode_kline_arrays(spark.read.parquet(out))[0]


@register("tolerant_decode")
def q_tolerant_decode(spark, sf_dir):
    replies = rp.error_reply_for(rp.kline_array_replies(bars(spark, sf_dir, stored=True)), FAILING_SYMBOL)
    good, _ = rp.decode_kline_arrays(replies)
    return good


@register("symbol_list")
def q_symbol_list(spark, sf_dir):
    return rp.decode_market_list(rp.market_list_replies(table(spark, sf_dir, "events")))


@register("symbol_prefix_filter")
def q_symbol_prefix_filter(spark, sf_dir):
    return rp.symbols_with_prefix(q_symbol_list(spark, sf_dir), SYMBOL_PREFIX)


@register("kline_message_decode")
def q_kline_message_decode(spark, sf_dir):
    return rp.decode_kline_messages(rp.kline_messages(bars(spark, sf_dir, stored=True)))


def damaged_messages(spark, sf_dir) -> DataFrame:
    """The stream's messages with some of them damaged, by the hour of their bar: cut off, without or with a wrong event time, without or with a wrong body."""
    b = bars(spark, sf_dir, stored=True)
    text, hour = F.col("value"), F.pmod(floor_div(F.get_json_object("value", "$.k.t").cast("long"), 3_600_000), F.lit(24))
    damaged = (F.when(hour == 1, F.substring(text, 1, 60)).when(hour == 2, F.regexp_replace(text, '"E":[0-9]+', '"E":"soon"')).when(hour == 3, F.regexp_replace(text, '"E":[0-9]+,', ""))
               .when(hour == 4, F.regexp_replace(text, '"k":\\{.*\\}\\}', '"x":1}')).when(hour == 5, F.regexp_replace(text, '"k":\\{.*\\}\\}', '"k":"none"}')).otherwise(text))
    return rp.kline_messages(b).select(damaged.alias("value"))


@register("message_rejects")
def q_message_rejects(spark, sf_dir):
    """Messages by what became of them; decoded and rejected ones are all there are."""
    tagged = rp.tag_kline_messages(damaged_messages(spark, sf_dir))
    return tagged.groupBy(F.coalesce("reason", F.lit("decoded")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("raw").isNotNull()).alias("n_raw"))


@register("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    """S7/F9 on the stream: the side table that the append query writes with each batch."""
    paths = sk.new_paths(spark, "stream-rejects")
    sk.land_messages(damaged_messages(spark, sf_dir), paths.landing)
    sk.run_until_done(sk.append_market_query(spark, paths, files_per_trigger=max(1, spark.sparkContext.defaultParallelism // 2)))
    kept = sk.read_market(spark, paths).agg(F.lit("decoded").alias("outcome"), F.count(F.lit(1)).alias("n"))
    return kept.unionByName(sk.read_rejects(spark, paths).groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n")))


@register("json_field")
def q_json_field(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@register("price_snapshot")
def q_price_snapshot(spark, sf_dir):
    return rp.decode_price_snapshots(rp.price_snapshot_records(table(spark, sf_dir, "events")))


@register("nested_balance_filter")
def q_nested_balance_filter(spark, sf_dir):
    return rp.balances_for_assets(rp.balance_replies(table(spark, sf_dir, "events")), BALANCE_ASSETS)


@register("trade_list_decode")
def q_trade_list_decode(spark, sf_dir):
    """Trade lists (one reply per event, its value as price) decoded to typed rows."""
    ev = table(spark, sf_dir, "events")
    trade = F.struct(F.col("event_type").alias("symbol"), F.col("event_id").alias("id"), F.col("user_id").alias("orderId"),
                     F.format_string("%.8f", "value").alias("price"), F.lit("2.00000000").alias("qty"), F.lit("junk").alias("quoteQty"),
                     F.lit("0.00100000").alias("commission"), F.lit("unit").alias("commissionAsset"), epoch_ms("ts").alias("time"),
                     (F.col("event_id") % 2 == 0).alias("isBuyer"), F.lit(False).alias("isMaker"), F.lit(True).alias("isBestMatch"))
    return rp.decode_trades(ev.select(F.to_json(F.array(trade)).alias("reply"))).select(
        "trade_id", "symbol", "order_id", F.round("price", 6).alias("price"), "qty", "quote_qty", "time", "is_buyer", "is_maker")


@register("json_reader")
def q_json_reader(spark, sf_dir):
    """S3: the format/options reader with a declared schema, over bars kept as JSON lines."""
    b = bars(spark, sf_dir, stored=True).select("market", "datetime", "open", "close", "nbr_trades")
    path = scratch_path(spark, "bars-json")
    b.write.json(path)
    return read_with_schema(spark, path, "json", "market string, datetime long, open double, close double, nbr_trades long")


@register("dropped_columns")
def q_dropped_columns(spark, sf_dir):
    """F3 as a frame: the columns that hold a NULL are gone, all rows stay."""
    b = bars(spark, sf_dir, stored=True).select("market", "datetime", "close", "volume", "nbr_trades")
    return cl.drop_null_columns(b.withColumn("volume", F.when(F.pmod(floor_div("datetime", 3_600_000), F.lit(24)) != 3, F.col("volume")))
                                .withColumn("empty", F.lit(None).cast("double")))


@register("chunk_plan_1h")
def q_chunk_plan_1h(spark, sf_dir):
    """G1 with the one-day gap and hourly interval."""
    ticks = ticks_from_events(table(spark, sf_dir, "events"))
    return ch.chunk_plan(ch.spans_from_ticks(ticks, "market", "t_us"), interval="1h", gap_ms=86_400_000)


@register("reply_rejects")
def q_reply_rejects(spark, sf_dir):
    """the replies that do not decode, kept aside and counted by symbol."""
    replies = rp.error_reply_for(rp.kline_array_replies(bars(spark, sf_dir, stored=True)), FAILING_SYMBOL)
    _, bad = rp.decode_kline_arrays(replies)
    return bad.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rejected"))


@register("chunk_plan")
def q_chunk_plan(spark, sf_dir):
    ticks = ticks_from_events(table(spark, sf_dir, "events"))
    return ch.chunk_plan(ch.spans_from_ticks(ticks, "market", "t_us"), interval="1m", gap_ms=0)


# --- serving (A1, A2, F6-F8, F10, M2) -----------------------------------------

BUY_LIMIT = 50.0
TICK = 0.01


def data_window(spark, sf_dir, days: int = 7) -> tuple[int, int, date]:
    """(start_ms, end_ms, today) of the serving window at the data's "today", the day
    of the last bar: one row from the store's file index, dates by Spark's own functions."""
    last = store.bar_stats(spark, bar_store_path(spark, sf_dir)).files().agg(ms_to_ntz(F.max("hi")).alias("m"))
    lo, hi, end = last.select(*serving_bounds("m", days)).first()
    return lo, hi, end - timedelta(days=1)


def data_as_of(spark, sf_dir) -> date:
    return data_window(spark, sf_dir)[2]


@register("serving_window_avg")
def q_serving_window_avg(spark, sf_dir):
    lo, hi, as_of = data_window(spark, sf_dir, 7)
    wide = mx.wide_enrich(long_with_range_avg(spark, sf_dir, lo, hi), WIDE_DRIVER, WIDE_OTHERS)
    return sv.window_averages(wide, FEATURE_MARKETS, as_of, days=7)


@register("buy_signal")
def q_buy_signal(spark, sf_dir):
    scored = sv.naive_prediction(q_market_feature_matrix(spark, sf_dir), FEATURE_MARKETS)
    return scored.select("datetime", "prediction", buy_signal("prediction", BUY_LIMIT).alias("buy"))


@register("limit_price")
def q_limit_price(spark, sf_dir):
    m = q_market_feature_matrix(spark, sf_dir)
    col = f"{TARGET_MARKET}_close"
    return m.select("datetime", col, limit_price(col, 1.01, TICK).alias("order_price"))


# --- machine learning (ML1-ML14, A8-A10, S13) ---------------------------------

TARGET_COL = f"{TARGET_MARKET}_close"


def matrix_stats(spark, sf_dir) -> StoreStats:
    """The split matrix, written once per session by month with the moments of its continuous columns."""
    def made() -> DataFrame:
        return mf.with_split(q_market_feature_matrix(spark, sf_dir), "datetime", 75).withColumn(store.MONTH, store.month_of())

    schema = made().schema
    columns = mf.continuous_columns(schema.fieldNames(), exclude=(TARGET_COL, "datetime"))

    def write(path: str) -> None:
        made().repartition(store.MONTH).write.partitionBy(store.MONTH).parquet(path)
        StoreStats(spark, path, schema, store.MONTH, ["is_train"], columns, "datetime").update()
    return StoreStats(spark, stored_once(spark, sf_dir, "matrix", write), schema, store.MONTH, ["is_train"], columns, "datetime")


def split_matrix(spark, sf_dir) -> DataFrame:
    return matrix_stats(spark, sf_dir).rows().drop(store.MONTH)


@register("hash_split")
def q_hash_split(spark, sf_dir):
    return split_matrix(spark, sf_dir).select("datetime", "split_bucket", "is_train")


@register("scaled_features")
def q_scaled_features(spark, sf_dir):
    """ML4: the fit is a merge of the stored moments of the train rows, the matrix is read once."""
    stored = matrix_stats(spark, sf_dir)
    z = mf.standardise(stored.rows(), stats.population(stored.moments().filter("is_train")))
    return z.select("datetime", *[F.round(c, 6).alias(c) for c in stored.columns])


@register("one_hot_calendar")
def q_one_hot_calendar(spark, sf_dir):
    """(datetime, feature, hot): categories learned from the train rows."""
    train = split_matrix(spark, sf_dir).filter("is_train")
    return mf.one_hot_long(train, train, "datetime")


@register("rmse_per_market")
def q_rmse_per_market(spark, sf_dir):
    r = q_trailing_avg_rows7(spark, sf_dir)
    err = F.col("close") - F.col("rolling_avg_7d")
    return r.groupBy("market").agg(F.count(F.lit(1)).alias("n"),
                                   F.round(F.sqrt(F.avg(err * err)), 6).alias("rmse"))


@register("r2_per_market")
def q_r2_per_market(spark, sf_dir):
    r = q_trailing_avg_rows7(spark, sf_dir)
    y, err = F.col("close"), F.col("close") - F.col("rolling_avg_7d")
    g = r.groupBy("market").agg(F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("ss_res"), F.var_pop(y).alias("var"))
    ss_tot = F.col("var") * F.col("n")                # centred: no cancellation for large prices
    # a constant series has no variance: R² is undefined (NULL), not an error
    return g.select("market", "n", F.round(F.lit(1.0) - F.try_divide(F.col("ss_res"), ss_tot), 6).alias("r2"))


def _fit_checked(spark, sf_dir, name, checks):
    """Test rows of a fit with what SQL can state about it: ``checks`` gets the
    scored train rows and gives one row of booleans."""
    prep = mm.PreparedSplit(split_matrix(spark, sf_dir), TARGET_COL)
    try:
        model, scored = prep.fit(name)
        train = prep.train
        for stage in model.stages[len(prep.features.stages):]:
            train = stage.transform(train)
        flags = checks(train).first().asDict()
    finally:
        prep.close()
    return scored, flags


def _flagged(scored, flags):
    return scored.select("datetime", "label", *[F.lit(bool(v)).alias(k) for k, v in flags.items()])


@register("train_linear")
def q_train_linear(spark, sf_dir):
    """Least squares: train residuals have mean 0 and no product with any feature (the normal equations)."""
    def normal_equations(train):
        residual = F.col("label") - F.col("prediction")
        sums = (train.select(residual.alias("e"), F.posexplode(vector_to_array("features")))
                .groupBy("pos").agg(F.abs(F.avg(F.col("e") * F.col("col"))).alias("g"), F.abs(F.avg("e")).alias("m")))
        return sums.agg((F.greatest(F.max("g"), F.max("m")) < 0.05).alias("normal_equations"))
    return _flagged(*_fit_checked(spark, sf_dir, "Linear_Regression", normal_equations))


def _tree(name):
    def q(spark, sf_dir):
        """A tree's prediction is a mean of train labels: it lies between their least and greatest."""
        prep = mm.PreparedSplit(split_matrix(spark, sf_dir), TARGET_COL)
        try:
            span = prep.train.agg(F.min("label").alias("lo"), F.max("label").alias("hi")).first()
            _, scored = prep.fit(name)
        finally:
            prep.close()
        inside = F.col("prediction").between(span["lo"] - 1e-9, span["hi"] + 1e-9)
        return scored.select("datetime", "label", inside.alias("within_train_labels"))
    return q


register("train_decision_tree")(_tree("Decision_Tree"))
register("train_random_forest")(_tree("Random_Forest"))


@register("train_gbt")
def q_train_gbt(spark, sf_dir):
    """Boosting fits the train rows better than their mean does."""
    def better(train):
        e = F.col("label") - F.col("prediction")
        return train.agg((F.avg(e * e) < F.var_pop("label")).alias("beats_the_mean"))
    return _flagged(*_fit_checked(spark, sf_dir, "Gradient_Boosted_Trees", better))


@register("best_model")
def q_best_model(spark, sf_dir):
    """The model of least RMSE among all candidates, checked against the stored scores of all of them."""
    path = scratch_path(spark, "scores")
    scores = mm.compare_models(spark, split_matrix(spark, sf_dir), TARGET_COL, scores_path=path)
    best = mm.select_best(scores).first()
    error = F.col("label") - F.col("prediction")
    again = mm.read_scores(spark, path).groupBy("model").agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    least = again.agg(F.min("rmse").alias("least"), F.min_by("model", "rmse").alias("name")).first()
    return scores.agg(F.count(F.lit(1)).alias("candidates"),
                      F.lit(bool(abs(best["best_rmse"] - least["least"]) <= 1e-6 * least["least"] and least["name"] == best["best_model"])).alias("best_has_least_rmse"),
                      F.count_if("is_best").alias("chosen"))


# --- models whose fit SQL can restate (ML8-ML10, A8, ML14) --------------------

CALENDAR_FEATURES = ["day", "month", "day_of_week"]           # few distinct values
ROLLING_FEATURES = [f"{m}_rolling_avg_7d" for m in FEATURE_MARKETS]
FIRST_BINS, FIRST_DEPTH, RATE, PENALTY = 16, 2, 0.3, 1.0


def _labelled_split(spark, sf_dir):
    m = materialize(mm.labelled(split_matrix(spark, sf_dir), TARGET_COL))
    return m, m.filter("is_train"), m.filter(~F.col("is_train"))


def _shallow_tree(train):
    return Pipeline(stages=[VectorAssembler(inputCols=CALENDAR_FEATURES, outputCol="features"), DecisionTreeRegressor(maxDepth=FIRST_DEPTH, maxBins=64)]).fit(train)


def _fitted_splits(node, at=1):
    """(node, feature, threshold) of an MLlib tree; node k has children 2k and 2k + 1."""
    if node.subtreeDepth() == 0:
        return []
    split = node.split()
    return [(at, CALENDAR_FEATURES[split.featureIndex()], split.threshold()), *_fitted_splits(node.leftChild(), 2 * at), *_fitted_splits(node.rightChild(), 2 * at + 1)]


@register("tree_splits")
def q_tree_splits(spark, sf_dir):
    """ML8: the exact splits of a tree of two levels, and whether MLlib's fitted tree has the same."""
    _, train, _ = _labelled_split(spark, sf_dir)
    exact = sp.grow(train, CALENDAR_FEATURES, "label", FIRST_DEPTH)
    fitted = set(_fitted_splits(_shallow_tree(train).stages[-1]._call_java("rootNode")))
    rows = [(s["node"], s["feature"], s["threshold"], s["n_left"], s["n_right"], round(s["gain"], 4), (s["node"], s["feature"], s["threshold"]) in fitted) for s in exact]
    return spark.createDataFrame(rows, "node int, feature string, threshold double, n_left long, n_right long, gain double, fitted boolean")


def _first_tree(train):
    """Second-order boosting of one round over the rolling averages."""
    assembler = VectorAssembler(inputCols=ROLLING_FEATURES, outputCol="features")
    return Pipeline(stages=[assembler, HistogramBoosting(rounds=1, depth=FIRST_DEPTH, rate=RATE, penalty=PENALTY, bins=FIRST_BINS)]).fit(train)


@register("boosting_first_tree")
def q_boosting_first_tree(spark, sf_dir):
    """ML10: splits (feature, upper end of the left bins) and weights of the first tree, node 0 its root."""
    _, train, _ = _labelled_split(spark, sf_dir)
    _, cuts, trees = _first_tree(train).stages[-1].parsed()
    tree, rows = trees[0], []
    for k in range(len(tree.feature)):
        if k == 0 or tree.feature[(k - 1) // 2] >= 0:
            f = int(tree.feature[k])
            rows.append((k, ROLLING_FEATURES[f] if f >= 0 else None, round(cuts[f][tree.bin[k]], 6) if f >= 0 else None, round(float(tree.weight[k]), 6)))
    return spark.createDataFrame(rows, "node int, feature string, cut double, weight double")


def _linear_on_rolling():
    return Pipeline(stages=[VectorAssembler(inputCols=ROLLING_FEATURES, outputCol="features"), LinearRegression(solver="normal")])


def _candidates(spark, sf_dir):
    """(model, key, label, prediction): linear on the rolling averages, a tree of two levels on the calendar, one round of boosting."""
    _, train, test = _labelled_split(spark, sf_dir)
    scored = [model.transform(test).select(F.lit(name).alias("model"), F.col("datetime").alias("key"), "label", "prediction")
              for name, model in (("linear", _linear_on_rolling().fit(train)), ("tree", _shallow_tree(train)), ("boosting", _first_tree(train)))]
    path = scratch_path(spark, "candidates")
    ex.union_all(scored).write.partitionBy("model").parquet(path)
    return mm.read_scores(spark, path)


@register("candidate_scores")
def q_candidate_scores(spark, sf_dir):
    """ML14: predictions of every candidate for every test row, as the selection stores them."""
    return _candidates(spark, sf_dir).withColumn("prediction", F.round("prediction", 4))


@register("best_candidate")
def q_best_candidate(spark, sf_dir):
    """RMSE of every candidate from the stored scores, the least flagged."""
    return mm.model_metrics(_candidates(spark, sf_dir)).select("model", F.round("rmse", 4).alias("rmse"), "is_best")


def _fitted_linear(spark, sf_dir):
    """Linear pipeline fitted on the persisted, featurized train split."""
    prep = mm.PreparedSplit(split_matrix(spark, sf_dir), TARGET_COL)
    try:
        model, _ = prep.fit("Linear_Regression")
    finally:
        prep.close()
    return model


@register("model_roundtrip_score")
def q_model_roundtrip_score(spark, sf_dir):
    data = mm.labelled(split_matrix(spark, sf_dir), TARGET_COL)
    model = _fitted_linear(spark, sf_dir)
    path = scratch_path(spark, "model-linear")
    mm.save_model(model, path)
    test = data.filter(~F.col("is_train"))
    loaded = mm.load_model(path).transform(test).select("datetime", "label", F.col("prediction").alias("loaded"))
    return loaded.join(model.transform(test).select("datetime", "prediction"), "datetime").select(
        "datetime", "label", (F.col("loaded") == F.col("prediction")).alias("loaded_equals_saved"))


@register("close_time_linear")
def q_close_time_linear(spark, sf_dir):
    """The short MLlib path: 8-row averages of the four feature markets (EUR, USDC,
    DAI, GBP order) → vector, target close as label → 80/20 split → linear model,
    saved and loaded back → test predictions."""
    m = q_close_time_matrix(spark, sf_dir)
    order = [FEATURE_MARKETS[0], FEATURE_MARKETS[3], FEATURE_MARKETS[1], FEATURE_MARKETS[2]]
    cols = [f"{mk}_average" for mk in order] + [f"{TARGET_MARKET}_close_price"]
    data = mf.with_split(mf.vector_frame(m, cols, keep=("close_time",)), "close_time", 80)
    model = LinearRegression(featuresCol="features", labelCol="label").fit(data.filter("is_train"))
    path = scratch_path(spark, "model-close-time")
    model.write().overwrite().save(path)
    loaded = LinearRegressionModel.load(path)
    return loaded.transform(data.filter(~F.col("is_train"))).select("close_time", "label", F.round("prediction", 4).alias("prediction"))


@register("score_requests")
def q_score_requests(spark, sf_dir):
    model = _fitted_linear(spark, sf_dir)
    req = sv.daily_requests(q_driver_left_enrich(spark, sf_dir), FEATURE_MARKETS)
    need = ["day", "month", "year", "day_of_week"] + [
        f"{m}_{c}" for m in FEATURE_MARKETS for c in FEATURE_COLUMNS]
    require_columns(req, need, "scoring request")
    # requests carry Monday = 0; the model was trained with Monday = 1
    req = req.withColumn("day_of_week", F.col("day_of_week") + F.lit(1))
    req = materialize(req.withColumn("accepted", mm.accepts(model)))
    scored = model.transform(req.where("accepted"))
    # a request that the model cannot score (a missing value, an unseen calendar value) is answered without a prediction
    answers = (scored.select("request_day_ms", "accepted", "prediction", buy_signal("prediction", BUY_LIMIT).alias("buy"))
               .unionByName(req.where("not accepted").select("request_day_ms", "accepted"), allowMissingColumns=True))
    return answers.select("request_day_ms", "accepted", (F.col("prediction").isNotNull() & F.col("buy").isNotNull()).alias("answered"))


@register("request_predictions")
def q_request_predictions(spark, sf_dir):
    """ML12/S13: the linear model on the rolling averages, saved and loaded, scores every day's request."""
    _, train, _ = _labelled_split(spark, sf_dir)
    path = scratch_path(spark, "model-requests")
    mm.save_model(_linear_on_rolling().fit(train), path)
    req = sv.daily_requests(q_driver_left_enrich(spark, sf_dir), FEATURE_MARKETS)
    require_columns(req, ROLLING_FEATURES, "scoring request")
    scored = mm.load_model(path).transform(req.dropna(subset=ROLLING_FEATURES))
    return scored.select("request_day_ms", F.round("prediction", 4).alias("prediction"), buy_signal("prediction", BUY_LIMIT).alias("buy"))


# --- streaming (K1-K5, S7-S10) -----------------------------------------------

def _landed(spark, sf_dir, name):
    paths = sk.new_paths(spark, name)
    # two batches, each of half the files
    sk.land_messages(rp.kline_messages(bars(spark, sf_dir, stored=True)), paths.landing)
    return paths, max(1, spark.sparkContext.defaultParallelism // 2)


@register("stream_append_market")
def q_stream_append_market(spark, sf_dir):
    paths, files = _landed(spark, sf_dir, "stream-append")
    sk.run_until_done(sk.append_market_query(spark, paths, files_per_trigger=files))
    return sk.read_market(spark, paths).drop("event_day")


def _wide_stream(spark, sf_dir):
    paths, files = _landed(spark, sf_dir, "stream-wide")
    sk.run_until_done(sk.wide_upsert_query(spark, paths, WIDE_DRIVER, WIDE_OTHERS, files_per_trigger=files))
    return paths


@register("stream_trailing_avg")
def q_stream_trailing_avg(spark, sf_dir):
    paths = _wide_stream(spark, sf_dir)
    return sk.read_averages(spark, paths).select("symbol", "event_timestamp", "close", "rolling_avg_7d")


@register("stream_wide_upsert")
def q_stream_wide_upsert(spark, sf_dir):
    paths = _wide_stream(spark, sf_dir)
    return sk.read_wide(spark, paths, WIDE_DRIVER, WIDE_OTHERS).drop("event_day")


def _late_rule():
    """Bars of one market, every sixth hour of the first half of all times, come at the end of the stream."""
    return (F.col("market") == WIDE_OTHERS[0]) & (F.pmod(floor_div("datetime", 3_600_000), F.lit(6)) == 5)


def _finalised(spark, sf_dir):
    """The stream in four files by time, then the late messages, then a message that flushes the state."""
    paths = sk.new_paths(spark, "stream-final")
    b = bars(spark, sf_dir, stored=True).filter(F.col("market").isin(FEATURE_MARKETS))
    span = b.agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi")).first()
    width = (span["hi"] - span["lo"]) // 4 + 1
    part = floor_div(F.col("datetime") - F.lit(span["lo"]), width)
    late = _late_rule() & (part < 2)
    flush = spark.createDataFrame([(fin.flush_message(span["hi"] + 100 * WEEK_MS),)], "value string")
    files = [rp.kline_messages(b.filter((part == k) & ~late)) for k in range(4)] + [rp.kline_messages(b.filter(late)), flush]
    for messages in files:
        sk.land_messages(messages, paths.landing, files=1, mode="append")
    sk.run_until_done(fin.final_query(spark, paths, FEATURE_MARKETS, "1 hour"))
    sk.run_until_done(sk.append_market_query(spark, paths, files_per_trigger=len(files)))
    final = fin.read_final(spark, paths, FEATURE_MARKETS)
    return final, fin.late_rows(sk.read_market(spark, paths), final)


@register("stream_final_wide")
def q_stream_final_wide(spark, sf_dir):
    """K4 with state and watermark: final rows and the late ones beside them give the whole wide table."""
    return fin.wide_rows(fin.complete(*_finalised(spark, sf_dir)), WIDE_DRIVER, WIDE_OTHERS)


@register("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """K4: messages by market and side; each is in a final row or among the late ones."""
    final, late = _finalised(spark, sf_dir)
    return (final.select("market", F.lit("final").alias("side")).unionByName(late.select("market", F.lit("late").alias("side")))
            .groupBy("market", "side").agg(F.count(F.lit(1)).alias("n")))
