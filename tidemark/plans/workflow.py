"""The reference's daily flow as one driver function (its scheduler re-aimed).

ingest → feature matrix (written as a table, never collected) → split and
shared preprocessing → four models fitted and compared → best model saved →
serving request for the day after the data → prediction, buy decision and
limit price. Only metrics and the one serving row reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions.pricing import buy_signal, limit_price
from tidemark.ml import features as mf
from tidemark.ml import models as mm
from tidemark.operators import matrix as mx
from tidemark.operators import serving as sv
from tidemark.session import scratch_path


@dataclass
class DailyResult:
    matrix_path: str
    model_path: str
    scores: list[tuple[str, float, float]] = field(default_factory=list)
    best_model: str = ""
    prediction: float | None = None
    buy: bool | None = None
    order_price: float | None = None


def run_daily(spark: SparkSession, sf_dir: str, limit: float = 50.0, markup: float = 1.01,
              tick: float = 0.01, models: list[str] = mm.MODEL_NAMES, as_of: date | None = None) -> DailyResult:
    """``as_of``: the serving day (default: the data's last). Its request is scored for the day after, without
    a prediction if the model has not learned that day's calendar values."""
    from tidemark.plans import catalog as cat   # the registered stand-in sources

    # load + preprocess: bar store, then the wide matrix as a table
    bars = cat.bars(spark, sf_dir, stored=True)
    matrix_path = scratch_path(spark, "matrix")
    mx.feature_matrix(bars, cat.TARGET_MARKET, cat.FEATURE_MARKETS).write.parquet(matrix_path)
    matrix = mf.with_split(spark.read.parquet(matrix_path), "datetime", 75)

    # training and selection
    fitted: dict = {}
    scores = mm.compare_models(spark, matrix, cat.TARGET_COL, models, fitted=fitted)
    rows = [(r["model"], r["rmse"], r["r2"]) for r in scores.collect()]     # one row per model
    best = mm.select_best(scores).first()["best_model"]
    model_path = scratch_path(spark, f"model-{best}")
    mm.save_model(fitted[best], model_path)

    # serving: averages over the last 7 days of the wide table, scored
    as_of = as_of or cat.data_as_of(spark, sf_dir)
    lo, hi, _ = sv.serving_window(as_of, 7)
    wide = mx.wide_enrich(cat.long_with_range_avg(spark, sf_dir, lo, hi), cat.WIDE_DRIVER, cat.WIDE_OTHERS)
    request = sv.window_averages(wide, cat.FEATURE_MARKETS, as_of, days=7)
    request = request.withColumn("day_of_week", F.col("day_of_week") + F.lit(1))  # Monday = 1 in training
    model = mm.load_model(model_path)
    # a day whose month or year the training rows did not have cannot be scored
    out = (model.transform(request.where(mm.accepts(model)))
           .select("prediction", buy_signal("prediction", limit).alias("buy")).first())
    # order price from the latest target close (a one-row aggregate)
    price = (bars.filter(F.col("market") == cat.TARGET_MARKET)
             .agg(F.max_by("close", "datetime").alias("c"))
             .select(limit_price("c", markup, tick).alias("p")).first())
    return DailyResult(matrix_path, model_path, rows, best,
                       out["prediction"] if out else None, out["buy"] if out else None,
                       price["p"] if price else None)


def main(argv: list[str] | None = None) -> None:
    """``python -m tidemark.plans.workflow SF_DIR [--cpus N] [--limit X]``"""
    import argparse
    import json

    from tidemark.session import build_session

    ap = argparse.ArgumentParser(description="run the daily market flow on one dataset")
    ap.add_argument("sf_dir")
    ap.add_argument("--cpus", default=None, help="run locally on N cores; without it the master of spark-submit or spark-defaults holds")
    ap.add_argument("--limit", type=float, default=50.0)
    a = ap.parse_args(argv)
    spark = build_session("tidemark-daily", a.cpus)
    try:
        r = run_daily(spark, a.sf_dir, limit=a.limit)
        print(json.dumps(r.__dict__, default=str))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
