import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.windows import (point_mean, trailing_mean_range, trailing_mean_range_plain,
                                        trailing_mean_rows, trailing_mean_rows_plain)


def brute_rows(rows, n):
    df = pd.DataFrame(rows, columns=["k", "t", "v"]).sort_values(["k", "t"])
    df["avg"] = df.groupby("k")["v"].transform(lambda s: s.rolling(n, min_periods=1).mean())
    return {(r.k, r.t): r.avg for r in df.itertuples()}


def brute_range(rows, length):
    out = {}
    for k, t, _ in rows:
        vals = [v for k2, t2, v in rows if k2 == k and t - length <= t2 <= t]
        out[(k, t)] = sum(vals) / len(vals)
    return out


def as_dict(df, col):
    return {(r["k"], r["t"]): r[col] for r in df.collect()}


def make(spark, rows):
    return spark.createDataFrame(rows, "k string, t long, v double")


def test_rows_frame_short_start_gaps_and_empty_chunks(spark):
    # market b has fewer than 7 rows; a has gaps leaving whole chunks empty
    rows = [("a", t, float(t)) for t in [0, 1, 2, 10, 11, 30, 31, 32, 33, 34, 35, 36, 37, 90]]
    rows += [("b", t, float(t) * 2) for t in [5, 6, 40]]
    got = as_dict(trailing_mean_rows(make(spark, rows), "k", "t", "v", 7, "avg", chunk_width=4), "avg")
    want = brute_rows(rows, 7)
    assert got.keys() == want.keys()
    for key in want:
        assert abs(got[key] - want[key]) < 1e-9, key


def test_rows_frame_matches_single_window_form(spark):
    rows = [(m, t, float((t * 7 + i) % 13)) for i, m in enumerate("xyz") for t in range(0, 200, 3)]
    df = make(spark, rows)
    a = as_dict(trailing_mean_rows(df, "k", "t", "v", 8, "avg", chunk_width=10), "avg")
    b = as_dict(trailing_mean_rows_plain(df, "k", "t", "v", 8, "avg"), "avg")
    assert a == b


def test_range_frame_matches_single_window_form(spark):
    rows = [(m, t, float((t * 5 + i) % 17)) for i, m in enumerate("xyz") for t in range(0, 300, 7)]
    df = make(spark, rows)
    a = as_dict(trailing_mean_range(df, "k", "t", "v", 30, "avg", chunk_width=11), "avg")
    b = as_dict(trailing_mean_range_plain(df, "k", "t", "v", 30, "avg"), "avg")
    assert a == b


def test_range_frame_includes_boundary(spark):
    rows = [("a", 0, 1.0), ("a", 7, 2.0), ("a", 8, 4.0), ("a", 15, 8.0), ("b", 15, 5.0)]
    got = as_dict(trailing_mean_range(make(spark, rows), "k", "t", "v", 7, "avg", chunk_width=3), "avg")
    assert got[("a", 7)] == 1.5          # t-7 = 0 is inside the frame
    assert got[("a", 15)] == (4.0 + 8.0) / 2   # frame [8, 15]
    assert got[("b", 15)] == 5.0


keyed_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 300),
              st.integers(-500, 500).map(lambda x: x / 4)),
    min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=keyed_rows, n=st.sampled_from([1, 2, 7, 8]), width=st.integers(1, 50))
def test_rows_frame_property(spark, rows, n, width):
    got = as_dict(trailing_mean_rows(make(spark, rows), "k", "t", "v", n, "avg", chunk_width=width), "avg")
    want = brute_rows(rows, n)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=keyed_rows, length=st.integers(0, 60), width=st.integers(1, 50))
def test_range_frame_property(spark, rows, length, width):
    got = as_dict(trailing_mean_range(make(spark, rows), "k", "t", "v", length, "avg", chunk_width=width), "avg")
    want = brute_range(rows, length)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_point_mean_equals_filter_then_window(spark):
    # two rows at the same event ms: the as-written stream query averages the peers
    rows = [("a", 100, 1.0), ("a", 100, 3.0), ("a", 200, 5.0)]
    got = {(r["k"], r["t"]): r["avg"] for r in point_mean(make(spark, rows), "k", "t", "v", "avg").collect()}
    assert got == {("a", 100): 2.0, ("a", 200): 5.0}


def test_row_frame_never_longer_than_n(spark):
    # values 0..29 in one key: each frame is exactly the last min(7, t+1) values
    got = trailing_mean_rows(make(spark, [("a", t, float(t)) for t in range(30)]), "k", "t", "v", 7, "avg",
                             chunk_width=4).collect()
    assert len(got) == 30
    for r in got:
        first = max(0, r["t"] - 6)
        assert r["avg"] == sum(range(first, r["t"] + 1)) / (r["t"] - first + 1)


def test_auto_chunk_width_follows_the_densest_key(spark):
    from tidemark.operators.windows import chunk_width_for
    # key a: 200 rows over 100 units (density 2); key b: 10 rows over 100 units
    rows = [("a", t // 2, float(t)) for t in range(200)] + [("b", t * 10, 1.0) for t in range(10)]
    rows = list({(k, t): (k, t, v) for k, t, v in rows}.values())   # unique (key, order)
    df = make(spark, rows)
    width = chunk_width_for(df, "k", "t", rows_per_chunk=20)
    assert 5 <= width <= 20
    a = as_dict(trailing_mean_rows(df, "k", "t", "v", 7, "avg", chunk_width="auto"), "avg")
    b = as_dict(trailing_mean_rows_plain(df, "k", "t", "v", 7, "avg"), "avg")
    assert a == b
    c = as_dict(trailing_mean_range(df, "k", "t", "v", 15, "avg", chunk_width="auto"), "avg")
    d = as_dict(trailing_mean_range_plain(df, "k", "t", "v", 15, "avg"), "avg")
    assert c == d


def test_narrow_range_chunks_split_a_hot_key(spark):
    """Prefix sums on two levels: equal to the single window, and a key with a third of the rows spreads over the tasks."""
    length, rows = 5000, []
    for k in range(30_000):
        key = "hot" if k % 3 == 0 else f"k{k % 20}"
        rows.append((key, (k * 7919) % 60_000, float(k % 101)))
    df = make(spark, rows)
    narrow = trailing_mean_range(df, "k", "t", "v", length, "avg", chunk_width=length // 50)
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "unboundedpreceding" in plan.lower()
    per_task = sorted(r["n"] for r in narrow.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    assert per_task[-1] <= 2 * per_task[len(per_task) // 2]
    plain = trailing_mean_range_plain(df, "k", "t", "v", length, "avg")
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, plain.collect()))


def test_narrow_range_chunks_with_null_keys_orders_and_values(spark):
    rows = [(None, 5, 1.0), (None, 7, 3.0), ("a", None, 2.0), ("a", None, 4.0), ("a", 0, None), ("a", 3, 1.0), ("a", 40, None), ("a", 41, 8.0), ("a", -9, 2.0)]
    df = make(spark, rows)
    for width in (1, 3, 10, 100):
        got = trailing_mean_range(df, "k", "t", "v", 10, "avg", chunk_width=width)
        assert sorted(map(str, got.collect())) == sorted(map(str, trailing_mean_range_plain(df, "k", "t", "v", 10, "avg").collect()))
