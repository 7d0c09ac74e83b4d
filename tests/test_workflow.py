import math
from datetime import date

from tidemark.plans.workflow import run_daily


def test_daily_flow_end_to_end(spark):
    r = run_daily(spark, "/root/testdata/sf0.01", models=["Linear_Regression", "Decision_Tree"], as_of=date(2024, 1, 20))
    assert spark.read.parquet(r.matrix_path).count() == 524
    assert {m for m, _, _ in r.scores} == {"Linear_Regression", "Decision_Tree"}
    assert r.best_model == min(r.scores, key=lambda x: x[1])[0]
    assert r.prediction is not None and math.isfinite(r.prediction)
    assert r.buy == (r.prediction < 50.0 and r.prediction != 0)
    assert r.order_price is not None and round(r.order_price, 2) == r.order_price


def test_a_day_of_an_unlearned_month_has_no_prediction(spark):
    r = run_daily(spark, "/root/testdata/sf0.01", models=["Linear_Regression"])      # the day after the data is in the next month
    assert r.prediction is None and r.buy is None and r.order_price is not None
