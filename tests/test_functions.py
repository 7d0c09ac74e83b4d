import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.pricing import buy_signal, limit_price
from tidemark.functions.timecols import calendar_columns, day_of_week, epoch_ms, ms_to_ntz
from tidemark.operators.serving import serving_window


def test_epoch_roundtrip_floors_micros(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:07.179575",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts"))
    r = df.select(epoch_ms("ts").alias("ms"), ms_to_ntz(epoch_ms("ts")).alias("back")).collect()[0]
    assert r["ms"] == 1704067207179
    assert r["back"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)


def test_epoch_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        df = spark.createDataFrame([(0,)], "ms long")
        assert df.select(ms_to_ntz("ms").alias("t")).first()["t"] == dt.datetime(1970, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_monday_and_sunday(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-07",)], "s string").select(
        F.col("s").cast("date").alias("d"))
    rows = df.select(*calendar_columns("d"), day_of_week("d", 0).alias("dow0")).collect()
    assert [(r["day_of_week"], r["dow0"]) for r in rows] == [(1, 0), (7, 6)]


def test_serving_window_bounds():
    start, end, end_day = serving_window(dt.date(2023, 10, 11), 7)
    assert end_day == dt.date(2023, 10, 12)
    assert (end - start) == 6 * 86_400_000


def test_limit_price_half_even_and_per_row_tick(spark):
    df = spark.createDataFrame([(12.5, 0.01), (29198.15, 0.1)], "p double, tick double")
    r = df.select(limit_price("p", 1.01, 0.01).alias("a"), limit_price("p", 1.01, tick_col="tick").alias("b")).collect()
    assert r[0]["a"] == round(12.5 * 1.01, 2)
    assert r[1]["a"] == round(29198.15 * 1.01, 2)
    assert abs(r[1]["b"] - 29490.1) < 1e-6


def test_buy_signal_ignores_zero_prediction(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (60.0,)], "p double")
    assert [r["b"] for r in df.select(buy_signal("p", 50.0).alias("b")).collect()] == [False, True, False]


def test_cluster_conf_and_materialize(spark):
    from tidemark.session import cluster_conf, materialize
    conf = cluster_conf(executors=10, cores_per_executor=4)
    assert conf["spark.sql.shuffle.partitions"] == "120"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    df = spark.range(0, 1000).withColumn("x", F.col("id") * 2).groupBy((F.col("id") % 7).alias("k")).count()
    m = materialize(df)
    assert sorted(m.collect()) == sorted(df.collect())
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan                      # lineage cut: reads the checkpoint
