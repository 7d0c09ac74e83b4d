from bar_frames import bar_rows
from pyspark.sql import functions as F

from tidemark.functions.timecols import calendar_columns, ms_to_ntz
from tidemark.operators import matrix as mx

H = 3_600_000


def with_calendar(df):
    d = ms_to_ntz("datetime")
    return df.select("*", *calendar_columns(d))


def fixture(spark):
    rows = []
    for i in range(12):
        t = i * H
        rows.append(("tgt", t, 100.0 + i))
        for j, m in enumerate(["f1", "f2"]):
            if not (m == "f2" and i == 5):          # a market missing at one timestamp
                rows.append((m, t, 10.0 * (j + 1) + i))
    rows.append(("f1", 99 * H, 1.0))                # no target row at this time
    return with_calendar(bar_rows(spark, rows))


def sorted_rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_one_pass_matrix_equals_join_form(spark):
    bars = fixture(spark)
    a = mx.feature_matrix(bars, "tgt", ["f1", "f2"], rows=7, chunk_width=3 * H)
    b = mx.feature_matrix_joins(bars, "tgt", ["f1", "f2"], rows=7, chunk_width=3 * H)
    assert sorted(a.columns) == sorted(b.columns)
    assert a.count() == 11                           # inner join: the gap drops one time
    assert sorted_rows(a) == sorted_rows(b)


def test_matrix_column_contract(spark):
    m = mx.feature_matrix(fixture(spark), "tgt", ["f1", "f2"])
    assert m.columns[:6] == ["datetime", "tgt_close", "day", "month", "year", "day_of_week"]
    assert m.columns[6:13] == ["f1_close", "f1_open", "f1_high", "f1_low", "f1_rolling_avg_7d",
                               "f1_nbr_trades", "f1_volume"]
    assert dict(m.dtypes)["f1_nbr_trades"] == "double"


def test_duplicate_keys_multiply_in_join_form_not_after_cleaning(spark):
    bars = fixture(spark)
    doubled = bars.unionByName(bars)
    joined = mx.feature_matrix_joins(doubled, "tgt", ["f1", "f2"]).count()
    assert joined == 11 * 2 ** 3                     # each of 3 copies-of-2 sides multiplies
    from tidemark.operators.cleaning import clean_bars
    assert mx.feature_matrix(clean_bars(doubled, ["market", "datetime", "close"]),
                             "tgt", ["f1", "f2"]).count() == 11


def test_wide_enrich_driver_gates_rows_and_defaults_zero(spark):
    rows = [("d", 0, 1.0), ("o1", 0, 2.0), ("o1", H, 3.0), ("d", 2 * H, 4.0), ("o2", 2 * H, 5.0)]
    long = bar_rows(spark, rows).withColumn("rolling_avg_7d", F.col("close"))
    w = mx.wide_enrich(long, "d", ["o1", "o2"]).orderBy("datetime").collect()
    assert [r["datetime"] for r in w] == [0, 2 * H]  # o1 alone at H is dropped
    assert w[0]["o1_close"] == 2.0 and w[0]["o2_close"] == 0.0 and w[0]["o2_nbr_trades"] == 0
    assert w[1]["o1_close"] == 0.0 and w[1]["o2_close"] == 5.0
    assert w[0]["day_of_week"] == 3                  # 1970-01-01 is a Thursday, Monday = 0


def test_driver_semi(spark):
    rows = [("d", 0, 1.0), ("o1", 0, 2.0), ("o1", H, 3.0)]
    got = mx.driver_semi(bar_rows(spark, rows), "d").collect()
    assert [(r["market"], r["datetime"]) for r in got] == [("o1", 0)]


def test_close_time_matrix_sorted_and_distinct(spark):
    m = mx.close_time_matrix(fixture(spark), "tgt", ["f1", "f2"], rows=8, chunk_width=2 * H)
    ct = [r["close_time"] for r in m.collect()]
    assert ct == sorted(ct) and len(ct) == len(set(ct)) == 11


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

presence = st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["tgt", "f1", "f2"]),
                              st.integers(1, 500)),
                    min_size=1, max_size=80, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=presence, width=st.integers(1, 10))
def test_one_pass_equals_joins_property(spark, rows, width):
    bars = with_calendar(bar_rows(spark, [(m, h * H, float(v)) for h, m, v in rows]))
    a = mx.feature_matrix(bars, "tgt", ["f1", "f2"], rows=7, chunk_width=width * H)
    b = mx.feature_matrix_joins(bars, "tgt", ["f1", "f2"], rows=7, chunk_width=width * H)
    assert sorted_rows(a) == sorted_rows(b)
