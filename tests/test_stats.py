import pytest
from pyspark.sql import functions as F

from tidemark.functions.timecols import MS_PER_DAY
from tidemark.operators.explore import latest_per_key
from tidemark.operators.explore import summary as scanned
from tidemark.session import scratch_path
from tidemark.sources import stats, store
from tidemark.sources.bars import bars_from_events
from tidemark.sources.tables import table

SF = "/root/testdata/sf0.001"


def by_key(df):
    return {(r[0], r["column_name"]): r for r in df.collect()}


@pytest.fixture(scope="module")
def bars(spark):
    return bars_from_events(table(spark, SF, "events")).cache()


def test_merged_moments_equal_a_scan(spark, bars):
    month = bars.withColumn("m", F.month("date"))
    parts = stats.moments(month, ["market", "m"], store.SUMMARY_COLUMNS)
    got, want = by_key(stats.summary(parts, "market")), by_key(scanned(bars, "market", store.SUMMARY_COLUMNS))
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert (got[k]["count"], got[k]["mean"], got[k]["min"], got[k]["max"]) == (w["count"], w["mean"], w["min"], w["max"])
        assert got[k]["stddev"] == pytest.approx(w["stddev"], abs=2e-6)


def test_moments_of_far_values_do_not_cancel_and_empty_parts_merge(spark):
    rows = [("a", 1, 3e7 + k * 1e-3) for k in range(50)] + [("a", 2, 3e7 + 1 + k * 1e-3) for k in range(50)] + [("a", 3, None), ("b", 1, 5.0), ("c", 1, None)]
    df = spark.createDataFrame(rows, "k string, m int, v double")
    got = by_key(stats.merged(stats.moments(df, ["k", "m"], ["v"]), ["k"]))
    values = [v for k, _, v in rows if k == "a" and v is not None]
    mean = sum(values) / len(values)
    assert got["a", "v"]["n"] == 100 and got["a", "v"]["m2"] == pytest.approx(sum((v - mean) ** 2 for v in values), rel=1e-6)
    assert got["b", "v"]["m2"] == 0 and got["c", "v"]["n"] == 0 and got["c", "v"]["mean"] is None
    assert stats.population(stats.moments(df, ["m"], ["v"]))["v"][0] == pytest.approx((sum(values) + 5) / 101)


def test_a_new_month_adds_rows_only(spark, bars):
    path = scratch_path(spark, "test-stats")
    later = F.col("datetime") + F.lit(45 * MS_PER_DAY)
    bars = bars.unionByName(bars.filter(F.col("datetime") % 5 == 0).withColumn("datetime", later)).cache()
    months = sorted(r[0] for r in bars.select(store.month_of().alias("m")).distinct().collect())
    assert len(months) > 1
    store.write_bars(bars.filter(store.month_of() != months[-1]), path)
    own = store.bar_stats(spark, path)
    own.update()
    before = own.tables.state().tables["moments"]
    store.append_bars(bars, path)
    after = own.tables.state().tables["moments"]
    assert set(after) - set(before) == {str(months[-1])}
    got, want = by_key(stats.summary(own.moments(), "market")), by_key(scanned(bars, "market", store.SUMMARY_COLUMNS))
    assert {k: (r["count"], r["mean"]) for k, r in got.items()} == {k: (r["count"], r["mean"]) for k, r in want.items()}
    assert own.files().agg(F.sum("rows")).first()[0] == bars.count()


def test_latest_rows_come_from_few_files(spark, bars):
    path = scratch_path(spark, "test-latest")
    first = bars.agg(F.min("datetime")).first()[0]
    for k in range(5):                                    # files by stretches of 6 days
        part = F.floor((F.col("datetime") - first) / (6 * MS_PER_DAY)) == k
        store.write_bars(bars.filter(part) if k < 4 else bars.filter(F.floor((F.col("datetime") - first) / (6 * MS_PER_DAY)) >= 4), path, mode="append")
    own = store.bar_stats(spark, path)
    own.update()
    for n in (1, 3, 24, 10_000):
        got = latest_per_key(own.latest("market", n).select("market", "datetime"), "market", "datetime", n)
        want = latest_per_key(bars.select("market", "datetime"), "market", "datetime", n)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    opened, every = stats.newest_files(own.files(), "market", 1).count(), own.files().count()
    assert 0 < opened <= 2 * 5 < every


def test_newest_files_keep_what_overlaps_the_bound(spark):
    files = spark.createDataFrame([("a", "f1", 0, 100, 50), ("a", "f2", 90, 95, 3), ("a", "f3", 80, 99, 2), ("a", "f4", 10, 79, 9), ("b", "g", 5, 6, 1)], "market string, path string, lo long, hi long, rows long")
    got = lambda n: sorted(r["path"] for r in stats.newest_files(files, "market", n).collect())
    assert got(3) == ["f1", "f2", "f3", "g"] and got(4) == ["f1", "f2", "f3", "g"] and got(6) == ["f1", "f2", "f3", "f4", "g"] and got(1000) == ["f1", "f2", "f3", "f4", "g"]
