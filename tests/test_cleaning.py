from bar_frames import bar_rows
from pyspark.sql import functions as F

from tidemark.operators.cleaning import clean_bars, drop_null_columns, kept_columns
from tidemark.schemas import SchemaContractError, require_columns


def test_clean_drops_zero_close_null_required_and_duplicates(spark):
    b = bar_rows(spark, [("a", 0, 1.0), ("a", 1, 0.0), ("a", 2, 3.0)])
    b = b.unionByName(b).withColumn("close", F.when(F.col("datetime") == 2, None).otherwise(F.col("close")))
    got = clean_bars(b).collect()
    assert [(r["market"], r["datetime"]) for r in got] == [("a", 0)]


def test_reingest_is_idempotent(spark):
    b = bar_rows(spark, [("a", t, 1.0 + t) for t in range(5)])
    once = sorted(clean_bars(b).collect())
    twice = sorted(clean_bars(b.unionByName(b).unionByName(b)).collect())
    assert once == twice


def test_drop_null_columns_drops_columns_not_rows(spark):
    b = bar_rows(spark, [("a", 0, 1.0), ("a", 1, 2.0)]).withColumn(
        "qav", F.when(F.col("datetime") == 1, None).otherwise(F.lit(1.0)))
    out = drop_null_columns(b)
    assert "qav" not in out.columns and out.count() == 2
    assert [r["column_name"] for r in kept_columns(b).orderBy("position").collect()] == [
        c for c in b.columns if c != "qav"]


def test_required_columns_fail_early_naming_all_missing(spark):
    # an older writer left out the calendar columns
    b = bar_rows(spark, [("a", 0, 1.0)])
    try:
        require_columns(b, ["market", "day", "month"], "bars")
    except SchemaContractError as e:
        assert "day" in str(e) and "month" in str(e)
    else:
        raise AssertionError("missing columns not reported")
