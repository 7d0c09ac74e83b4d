"""Scoring requests on a stream (ML12): request rows arrive as JSON files, are
checked row by row against the feature contract (the rest go to a rejects
stream), scored by a fitted pipeline and appended to a table. Every pipeline stage is a row-wise projection after fitting, so
the model applies to a streaming frame unchanged (no state, no watermark)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.pricing import buy_signal
from tidemark.ml.models import accepts
from tidemark.schemas import CALENDAR_COLUMNS, FEATURE_COLUMNS


def request_schema(markets: list[str], key: str = "request_day_ms") -> T.StructType:
    fields = [T.StructField(key, T.LongType())]
    fields += [T.StructField(c, T.IntegerType()) for c in CALENDAR_COLUMNS]
    fields += [T.StructField(f"{m.lower()}_{c}", T.DoubleType()) for m in markets for c in FEATURE_COLUMNS]
    return T.StructType(fields)


def request_stream(spark: SparkSession, model: PipelineModel, path: str, markets: list[str], monday_in_requests: int = 0) -> DataFrame:
    """Streaming frame of the request files under ``path``, with ``accepted``: all
    fields are there and the model has learned the calendar values."""
    schema = request_schema(markets)
    req = spark.readStream.schema(schema).json(path)
    if monday_in_requests != 1:
        req = req.withColumn("day_of_week", F.col("day_of_week") + F.lit(1 - monday_in_requests))
    return req.withColumn("accepted", accepts(model) & F.col(schema.fields[0].name).isNotNull())


def score_stream(spark: SparkSession, model: PipelineModel, path: str, markets: list[str],
                 limit: float, monday_in_requests: int = 0) -> DataFrame:
    """Streaming frame of (request key, prediction, buy) for the accepted requests under ``path``."""
    req = request_stream(spark, model, path, markets, monday_in_requests)
    scored = model.transform(req.where("accepted"))
    return scored.select(req.columns[0], "prediction",
                         buy_signal("prediction", limit).alias("buy"))


def rejected_stream(spark: SparkSession, model: PipelineModel, path: str, markets: list[str], monday_in_requests: int = 0) -> DataFrame:
    """The requests that ``score_stream`` leaves out, whole."""
    return request_stream(spark, model, path, markets, monday_in_requests).where("not accepted").drop("accepted")
