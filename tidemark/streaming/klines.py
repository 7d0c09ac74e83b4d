"""Live kline pipeline on Structured Streaming.

Messages arrive as JSON text files (a Kafka topic in production; same decode).
Each query keeps versioned tables under one root in the shared folder
(``sources.versions``); a batch changes all of them with one commit:

* ``market``   — long history by event day. A batch adds a folder to each of its
                 days; days of many folders are compacted, to the latest copy of
                 each message.
* ``rejects``  — messages that could not be decoded, with reason and text, by batch.
* ``averages`` — history rows with their trailing 7-day RANGE mean of close.
* ``wide``     — one row per driver-market event time with every market's 7
                 columns, absent markets 0 (keyed upsert).

A batch id that a version already holds is not applied again, so a replayed batch
changes nothing; a batch that dies before its commit leaves no trace. A reader
sees one version: history, averages and wide rows of the same batches.

Spark rejects non-time windows on streams, so the trailing mean and the wide
merge run in ``foreachBatch``. Each batch recomputes every day its rows can
change — each of its own days and the 7 after it, as a set — from the stored
history, and replaces those days. The result does not depend on arrival order: a
late row re-derives every average and wide row it touches, and no day between it
and the rest. Only the day folders needed are opened. A day's rows are written by
as many tasks as they fill files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timecols import MS_PER_DAY, floor_div
from tidemark.operators.matrix import wide_enrich
from tidemark.operators.windows import trailing_mean_range
from tidemark.schemas import FEATURE_COLUMNS, MARKET_TABLE_SCHEMA
from tidemark.session import scratch_path
from tidemark.sources.replies import tag_kline_messages
from tidemark.sources.versions import Folders, VersionedTables, dealt

WEEK_MS = 7 * MS_PER_DAY
CHUNK_MS = MS_PER_DAY           # chunk of the trailing mean: a hot market spreads over a task for each day
MOST_FOLDERS = 8                # folders of a day before it is compacted
ROW_KEY = ["symbol", "event_timestamp"]
_DAY = T.StructField("event_day", T.LongType())
MARKET = T.StructType([*MARKET_TABLE_SCHEMA.fields, T.StructField("batch_id", T.LongType()), T.StructField("arrival", T.LongType()), _DAY])
AVERAGES = T.StructType([*MARKET_TABLE_SCHEMA.fields, T.StructField("rolling_avg_7d", T.DoubleType()), _DAY])
REJECTS = T.StructType([T.StructField("reason", T.StringType()), T.StructField("raw", T.StringType()), T.StructField("batch_id", T.LongType())])


def wide_schema(driver: str, others: list[str]) -> T.StructType:
    values = [T.StructField(f"{m.lower()}_{c}", T.IntegerType() if c == "nbr_trades" else T.DoubleType()) for m in (driver, *others) for c in FEATURE_COLUMNS]
    return T.StructType([T.StructField("start_timestamp", T.LongType()), *[T.StructField(c, T.IntegerType()) for c in ("day", "month", "year", "day_of_week")], *values, _DAY])


@dataclass
class StreamPaths:
    root: str

    @property
    def landing(self): return f"{self.root}/landing"
    @property
    def checkpoint(self): return f"{self.root}/checkpoint"
    @property
    def append_tables(self): return f"{self.root}/append"
    @property
    def wide_tables(self): return f"{self.root}/wide"


def new_paths(spark: SparkSession, name: str = "klines") -> StreamPaths:
    return StreamPaths(scratch_path(spark, name))


def land_messages(messages: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    """Write message text as files, rows spread round-robin (arrival order is
    deliberately unrelated to event time), by default one for each core;
    ``mode="append"`` adds more files."""
    files = files or messages.sparkSession.sparkContext.defaultParallelism
    messages.repartition(files).write.mode(mode).text(path)


def message_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def _day(col: str):
    return floor_div(col, MS_PER_DAY)


def append_tables(spark: SparkSession, paths: StreamPaths) -> VersionedTables:
    return VersionedTables(spark, paths.append_tables, {"market": "event_day", "rejects": "batch_id"})


def wide_tables(spark: SparkSession, paths: StreamPaths) -> VersionedTables:
    return VersionedTables(spark, paths.wide_tables, {"market": "event_day", "rejects": "batch_id", "averages": "event_day", "wide": "event_day"})


class MarketAppend:
    """A ``foreachBatch`` body: decoded rows to the history, rejects beside them, by one commit.

    A message delivered twice is stored twice, whatever its delay, until its day
    is compacted; ``read_market`` returns it once."""

    def __init__(self, tables: VersionedTables):
        self.tables = tables

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        state = self.tables.state()
        if batch_id <= state.batch:
            return
        made, _ = self.store(batch, batch_id)
        self.tables.commit(state, {t: self.tables.added(state.tables.get(t, {}), f) for t, f in made.items()}, batch_id)
        self.tidy()

    def store(self, batch: DataFrame, batch_id: int) -> tuple[dict[str, Folders], list[int]]:
        """Folders written for both sides of a batch, and the days it has rows of."""
        rows = (tag_kline_messages(batch).withColumns({"event_day": _day("event_timestamp"), "arrival": F.monotonically_increasing_id(),
                                                       "batch_id": F.lit(batch_id).cast("long")}).persist(StorageLevel.MEMORY_AND_DISK))
        try:
            good, bad = rows.filter("reason is null").drop("reason", "raw"), rows.filter("reason is not null").select("reason", "raw", "batch_id")
            counts = {(r["ok"], r["event_day"]): r["n"] for r in rows.groupBy(F.col("reason").isNull().alias("ok"), "event_day").agg(F.count(F.lit(1)).alias("n")).collect()}   # a row per day of the batch
            days = [d for ok, d in counts if ok]
            made: dict[str, Folders] = {}
            if days:
                made["market"] = self.tables.write("market", dealt(good, "event_day", ROW_KEY, max(n for (ok, _), n in counts.items() if ok)))
            if len(days) < len(counts):
                made["rejects"] = self.tables.write("rejects", dealt(bad, "batch_id", ["raw"], sum(n for (ok, _), n in counts.items() if not ok)))
            return made, days
        finally:
            rows.unpersist()

    def tidy(self) -> None:
        self.tables.compact("market", MARKET, ROW_KEY, MOST_FOLDERS, lambda rows: latest_copies(rows).select(*MARKET.fieldNames()))


def _started(spark: SparkSession, paths: StreamPaths, body, name: str, trigger_once: bool, files_per_trigger: int):
    w = (message_stream(spark, paths.landing, files_per_trigger).writeStream
         .option("checkpointLocation", f"{paths.checkpoint}-{name}").foreachBatch(body))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 second")
    return w.start()


def append_market_query(spark: SparkSession, paths: StreamPaths, trigger_once: bool = True, files_per_trigger: int = 1):
    """K1 + S7 + S8: decode the stream and append to the ``market`` table; rejects are kept."""
    return _started(spark, paths, MarketAppend(append_tables(spark, paths)), "append", trigger_once, files_per_trigger)


def latest_copies(history: DataFrame) -> DataFrame:
    """One row per (symbol, event_timestamp), whole: a message delivered again (a
    reconnect) or corrected, in a later batch or later in the same one, replaces
    the earlier copy. A partial aggregate, so many copies of one message collapse
    before the shuffle."""
    order = [c for c in ("batch_id", "arrival") if c in history.columns]
    cols = [c for c in history.columns if c not in (*ROW_KEY, *order)]
    rank = F.struct(*[F.col(c) for c in (*order, *cols)])      # equal ranks are equal rows
    latest = F.max_by(F.struct(*order, *cols), rank).alias("_r")
    return history.groupBy(*ROW_KEY).agg(latest).select(*ROW_KEY, "_r.*")


def latest_per_message(history: DataFrame) -> DataFrame:
    """``latest_copies`` without the columns that tell copies apart."""
    return latest_copies(history).drop("batch_id", "arrival")


def read_market(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    """The history that the append query stored, each message once."""
    return latest_per_message(append_tables(spark, paths).read("market", MARKET))


def read_rejects(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    return append_tables(spark, paths).read("rejects", REJECTS)


class WideUpsert(MarketAppend):
    """The ``foreachBatch`` body: history append, trailing mean, wide merge, one commit."""

    def __init__(self, tables: VersionedTables, driver: str, others: list[str], length_ms: int = WEEK_MS):
        super().__init__(tables)
        self.driver, self.others, self.length = driver, others, length_ms

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        state = self.tables.state()
        if batch_id <= state.batch:
            return
        made, days = self.store(batch, batch_id)
        after = {t: self.tables.added(state.tables.get(t, {}), f) for t, f in made.items()}
        if days:
            reach = (self.length + MS_PER_DAY - 1) // MS_PER_DAY
            affected = sorted({d + k for d in days for k in range(reach + 1)})
            needed = sorted({d - k for d in affected for k in range(reach + 1)})      # one frame length before
            hist = latest_per_message(self.tables.read("market", MARKET, state, needed, made["market"])).persist(StorageLevel.MEMORY_AND_DISK)
            avg = trailing_mean_range(hist, "symbol", "event_timestamp", "close", self.length, "rolling_avg_7d", CHUNK_MS)
            avg = avg.filter(F.col("event_day").isin(affected)).select(*AVERAGES.fieldNames()).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                largest = avg.groupBy("event_day").count().agg(F.max("count")).first()[0]
                wide = (wide_enrich(avg.withColumnRenamed("symbol", "market"), self.driver, self.others, key="event_timestamp", monday=0)
                        .withColumnRenamed("event_timestamp", "start_timestamp").withColumn("event_day", _day("start_timestamp")))
                for name, rows, keys in (("averages", avg, ROW_KEY), ("wide", wide, ["start_timestamp"])):
                    after[name] = self.tables.replaced(state.tables.get(name, {}), self.tables.write(name, dealt(rows, "event_day", keys, largest)), affected)
            finally:
                avg.unpersist()
                hist.unpersist()
        self.tables.commit(state, after, batch_id)
        self.tidy()


def read_averages(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    return wide_tables(spark, paths).read("averages", AVERAGES)


def read_wide(spark: SparkSession, paths: StreamPaths, driver: str, others: list[str]) -> DataFrame:
    return wide_tables(spark, paths).read("wide", wide_schema(driver, others))


def wide_upsert_query(spark: SparkSession, paths: StreamPaths, driver: str, others: list[str],
                      trigger_once: bool = True, files_per_trigger: int = 1):
    """K3 + K4 + S9 + S10 as one streaming query with an idempotent batch body."""
    return _started(spark, paths, WideUpsert(wide_tables(spark, paths), driver, others), "wide", trigger_once, files_per_trigger)


def run_until_done(query, timeout_s: float | None = None) -> None:
    """K5: stop when the available input is processed (or after ``timeout_s``)."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
    if query.exception() is not None:
        raise query.exception()
