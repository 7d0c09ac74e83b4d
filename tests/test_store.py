import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources import store
from tidemark.sources.bars import bars_from_events
from tidemark.sources.tables import table
from tidemark.schemas import SchemaContractError

SF = "/root/testdata/sf0.001"


def test_append_twice_leaves_store_unchanged(spark):
    bars = bars_from_events(table(spark, SF, "events"))
    path = scratch_path(spark, "test-store")
    store.append_bars(bars, path)
    first = store.read_bars(spark, path)
    n = first.count()
    store.append_bars(bars, path)                  # the same ingest run again
    again = store.read_bars(spark, path)
    assert again.count() == n == bars.count()
    assert again.select("market", "datetime").distinct().count() == n
    assert sorted(first.columns) == sorted(bars.columns)


def test_partition_pruned_read(spark):
    path = scratch_path(spark, "test-store-prune")
    store.write_bars(bars_from_events(table(spark, SF, "events")), path)
    df = store.read_bars(spark, path).filter("market = 'view'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "view" in plan


def test_store_without_calendar_columns_fails_early(spark):
    path = scratch_path(spark, "test-store-old")
    bars = bars_from_events(table(spark, SF, "events")).drop("year", "month", "day", "day_of_week")
    bars.write.partitionBy("market").parquet(path)
    with pytest.raises(SchemaContractError, match="day_of_week"):
        store.read_bars(spark, path)


def test_one_whole_row_per_key(spark):
    from bar_frames import bar_rows
    b = bar_rows(spark, [("a", 0, 10.0), ("a", 1, 20.0)])
    later = b.where("datetime = 0").withColumn("close", F.lit(9.0)).withColumn("high", F.lit(1.0)).withColumn("nbr_trades", F.lit(4).cast("long"))
    got = {r["datetime"]: (r["close"], r["high"], r["nbr_trades"]) for r in store.unique_bars(b.unionByName(later).unionByName(b)).collect()}
    assert got == {0: (9.0, 1.0, 4), 1: (20.0, 21.0, 3)}      # columns of two rows are never mixed


def test_a_week_opens_only_its_files(spark):
    day = 86_400_000
    path = scratch_path(spark, "test-store-time")
    bars = bars_from_events(table(spark, "/root/testdata/sf0.01", "events"))
    store.write_bars(bars.repartition(7), path)
    lo = bars.agg({"datetime": "min"}).first()[0]
    week = store.time_slice(spark, path, lo, lo + 7 * day)
    assert week.count() == bars.where(f"datetime <= {lo + 7 * day}").count()
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "bar_month" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(datetime" in plan and "LessThanOrEqual(datetime" in plan
    spans = (spark.read.parquet(path).selectExpr("_metadata.file_path f", "market", "datetime")
             .groupBy("market", "f").agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi")).orderBy("market", "lo").collect())
    for a, b in zip(spans, spans[1:]):
        assert a["market"] != b["market"] or a["hi"] < b["lo"]      # files of a market follow one another in time
