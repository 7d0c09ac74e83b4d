import datetime as dt

from tidemark.operators.serving import daily_requests, window_averages
from tidemark.schemas import FEATURE_COLUMNS

DAY = 86_400_000


def wide(spark, rows):
    cols = ["datetime"] + [f"{m}_{c}" for m in ["a", "b"] for c in FEATURE_COLUMNS]
    data = []
    for t, a_close, b_close in rows:
        vals = []
        for close in (a_close, b_close):
            vals += [close, 1.0, 2.0, 0.5, close, 3, 4.0]
        data.append(tuple([t] + vals))
    schema = ", ".join(f"{c} {'long' if c == 'datetime' else ('int' if c.endswith('nbr_trades') else 'double')}"
                       for c in cols)
    return spark.createDataFrame(data, schema)


def test_close_average_ignores_zeros_other_columns_do_not(spark):
    as_of = dt.date(1970, 1, 8)                     # window: ms 2*DAY .. 8*DAY, both inclusive
    w = wide(spark, [(2 * DAY, 10.0, 0.0), (3 * DAY, 20.0, 6.0), (8 * DAY, 0.0, 0.0),
                     (1 * DAY, 99.0, 99.0), (9 * DAY, 99.0, 99.0)])
    r = window_averages(w, ["a", "b"], as_of).collect()[0]
    assert r["a_close"] == 15.0                      # the zero close is ignored
    assert r["b_close"] == 6.0
    assert r["a_rolling_avg_7d"] == 15.0             # all-zero row excluded; others average zeros in
    assert (r["day"], r["month"], r["year"], r["day_of_week"]) == (9, 1, 1970, 4)  # Friday, Monday = 0


def test_daily_requests_match_single_serving_row(spark):
    w = wide(spark, [(d * DAY + 5, float(d), float(d % 3)) for d in range(1, 20)])
    reqs = {r["request_day_ms"]: r for r in daily_requests(w, ["a", "b"]).collect()}
    for as_of_day in [5, 10, 15]:
        one = window_averages(w, ["a", "b"], dt.date(1970, 1, 1) + dt.timedelta(days=as_of_day)).collect()[0]
        many = reqs[(as_of_day + 1) * DAY]
        for c in one.asDict():
            assert one[c] == many[c], c
