import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.chunks import chunk_plan

DAY = 86_400_000


def ms(d):
    return int((d - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def plan(spark, spans, interval="1h", gap_ms=0):
    df = spark.createDataFrame(spans, "symbol string, start_ms long, end_ms long")
    return sorted((r["symbol"], r["chunk"], r["window_start_ms"], r["window_end_ms"])
                  for r in chunk_plan(df, interval, gap_ms).collect())


def test_historic_period_with_one_day_skip(spark):
    # 2019-01-01 .. 2023-09-25, hourly bars, a one-day skip after each window:
    # 41 requests (the progress log's last cycle), each ~41.67 days long
    s, e = ms(dt.datetime(2019, 1, 1)), ms(dt.datetime(2023, 9, 25))
    p = plan(spark, [("BTCUSDT", s, e)], "1h", DAY)
    assert len(p) == 41
    first = p[0]
    assert abs((first[3] - first[2]) / DAY - 41.6667) < 1e-3
    assert p[-1][3] == e


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.integers(1, 400), interval=st.sampled_from(["1h", "1m"]))
def test_gap_zero_tiles_span(spark, days, interval):
    s = ms(dt.datetime(2020, 1, 1))
    e = s + days * DAY
    p = plan(spark, [("X", s, e)], interval, 0)
    assert p[0][2] == s and p[-1][3] == e
    for a, b in zip(p, p[1:]):
        assert a[3] == b[2]                      # contiguous, no overlap, no hole
    assert all(w[3] > w[2] for w in p)


def test_span_shorter_than_a_day_is_one_window(spark):
    s = ms(dt.datetime(2020, 1, 1))
    assert plan(spark, [("X", s, s + 3_600_000)], "1m", 0) == [("X", 0, s, s + 3_600_000)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.integers(2, 400), gap_days=st.integers(1, 3))
def test_gap_windows_advance_by_period_plus_gap(spark, days, gap_days):
    s = ms(dt.datetime(2020, 1, 1))
    e = s + days * DAY
    p = plan(spark, [("X", s, e)], "1h", gap_days * DAY)
    assert p[0][2] == s and all(s <= w[2] < w[3] <= e for w in p)
    steps = {b[2] - a[2] for a, b in zip(p, p[1:])}
    assert len(steps) <= 1                                   # one constant stride
    for a, b in zip(p, p[1:]):
        assert b[2] - a[3] >= gap_days * DAY - 1             # the skipped gap, never overlap
