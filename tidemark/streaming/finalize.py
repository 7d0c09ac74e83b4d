"""Wide rows by event-time state with a watermark (K4, second form).

The stream is grouped by event time in Spark's state store: the columns of every
market are one conditional aggregate, so a time is one state row however many
messages it gets. When the watermark (largest event time seen less ``delay``) has
passed a time, its row is final, leaves the state and is appended; the state holds
the times of one delay.

A message that comes when its time is final cannot change it any more. The append
query keeps all messages; those that no final row holds are the late ones
(``late_rows``), counted beside the final rows, and ``complete`` adds them, so
nothing is lost. A stream that goes quiet keeps its last delay in the state:
``flush_message`` moves the watermark on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.matrix import wide_enrich
from tidemark.operators.windows import trailing_mean_range
from tidemark.sources.replies import decode_kline_messages
from tidemark.streaming.klines import CHUNK_MS, WEEK_MS, StreamPaths, message_stream

VALUES = ["open", "high", "low", "close", "volume", "nbr_trades"]
FLUSH_SYMBOL = ""


def flush_message(event_ms: int) -> str:
    """A message of no market that moves the watermark to ``event_ms`` less the delay."""
    return f'{{"e":"kline","E":{event_ms},"s":"{FLUSH_SYMBOL}","k":{{}}}}'


def final_path(paths: StreamPaths) -> str:
    return f"{paths.root}/final"


def _market(name: str) -> Column:
    """Values of one market at an event time; of copies the one of most trades, then of the greatest values."""
    values = F.struct(*VALUES)
    own = F.col("symbol") == name
    return F.max_by(F.when(own, values), F.when(own, F.struct("nbr_trades", *[c for c in VALUES if c != "nbr_trades"]))).alias(name)


def final_rows(messages: DataFrame, markets: list[str], delay: str) -> DataFrame:
    """Streaming frame (event_time, a struct for each market): a row once its time is final."""
    rows = decode_kline_messages(messages).withColumn("event_time", F.timestamp_millis("event_timestamp"))
    return rows.withWatermark("event_time", delay).groupBy("event_time").agg(*[_market(m) for m in markets])


def final_query(spark: SparkSession, paths: StreamPaths, markets: list[str], delay: str, trigger_once: bool = True, files_per_trigger: int = 1):
    """Append final rows to files, each once (the sink's commit log)."""
    w = (final_rows(message_stream(spark, paths.landing, files_per_trigger), markets, delay).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", f"{paths.checkpoint}-final"))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 second")
    return w.start(final_path(paths))


def read_final(spark: SparkSession, paths: StreamPaths, markets: list[str]) -> DataFrame:
    """Final rows as a long table: (market, event_timestamp, values); the flushing time itself never is final."""
    wide = spark.read.parquet(final_path(paths))
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("market"), F.col(m).alias("v")) for m in markets])).alias("m")
    return (wide.select(F.unix_millis("event_time").alias("event_timestamp"), each).filter(F.col("m.v").isNotNull())
            .select(F.col("m.market").alias("market"), "event_timestamp", "m.v.*"))


def late_rows(history: DataFrame, final: DataFrame) -> DataFrame:
    """Rows of ``history`` (symbol, event_timestamp, values; each message once) whose
    time is final and that no final row holds, in the columns of ``final``. Times
    still in the state are not late."""
    rows = history.filter(F.col("symbol") != FLUSH_SYMBOL).select(F.col("symbol").alias("market"), "event_timestamp", *VALUES)
    last = final.agg(F.max("event_timestamp")).first()[0]                # one value
    key = ["market", "event_timestamp", F.xxhash64(*VALUES).alias("h")]
    settled = rows.filter(F.col("event_timestamp") <= F.lit(last)).withColumn("h", key[-1])
    return settled.join(final.select(*key), ["market", "event_timestamp", "h"], "left_anti").drop("h")


def complete(final: DataFrame, late: DataFrame) -> DataFrame:
    """Final rows and late ones; a late copy of a final row replaces it."""
    both = final.withColumn("_late", F.lit(0)).unionByName(late.withColumn("_late", F.lit(1)))
    return (both.groupBy("market", "event_timestamp").agg(F.max_by(F.struct(*VALUES), F.struct("_late", *VALUES)).alias("v"))
            .select("market", "event_timestamp", "v.*"))


def wide_rows(long: DataFrame, driver: str, others: list[str], length_ms: int = WEEK_MS) -> DataFrame:
    """The wide table over (market, event_timestamp, values): trailing RANGE mean, then a row for each time of the driver market."""
    mean = trailing_mean_range(long, "market", "event_timestamp", "close", length_ms, "rolling_avg_7d", CHUNK_MS)
    return wide_enrich(mean, driver, others, key="event_timestamp", monday=0).withColumnRenamed("event_timestamp", "start_timestamp")
