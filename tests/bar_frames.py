"""Hand-made bar frames for the tests."""

from pyspark.sql import types as T


def bar_rows(spark, rows):
    """rows: (market, datetime_ms, close[, extra dict]) → bar-like frame."""
    schema = T.StructType([
        T.StructField("market", T.StringType()), T.StructField("datetime", T.LongType()),
        T.StructField("close", T.DoubleType()), T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()),
        T.StructField("nbr_trades", T.LongType()), T.StructField("volume", T.DoubleType()),
        T.StructField("close_time", T.LongType()),
    ])
    data = [(m, t, c, c - 1.0, c + 1.0, c - 2.0, 3, c * 2, t + 3_599_999) for m, t, c in rows]
    return spark.createDataFrame(data, schema)
