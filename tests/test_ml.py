import pytest
from pyspark.sql import functions as F

from tidemark.ml.features import PopStandardScaler, split_bucket, with_split
from tidemark.ml.models import learned_one_hot_stages
from pyspark.ml import Pipeline


def test_hash_split_is_deterministic_and_partition_free(spark):
    df = spark.range(0, 4000).withColumnRenamed("id", "datetime")
    a = with_split(df, "datetime").filter("is_train").select("datetime")
    b = with_split(df.repartition(7), "datetime").filter("is_train").select("datetime")
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    share = a.count() / 4000
    assert 0.72 < share < 0.78
    assert df.select(split_bucket(F.lit("123")).alias("b")).first()["b"] == 539801954 % 100


def test_population_scaler(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    m = PopStandardScaler(inputCols=["x"], outputCols=["z"]).fit(df)
    z = [r["z"] for r in m.transform(df).orderBy("x").collect()]
    sd = (1.25) ** 0.5                                # population std of 1..4
    assert z == pytest.approx([(v - 2.5) / sd for v in [1, 2, 3, 4]])


def test_learned_one_hot_drops_smallest_and_rejects_unseen(spark):
    train = spark.createDataFrame([(1,), (2,), (10,)], "day int")
    model = Pipeline(stages=learned_one_hot_stages(["day"])).fit(train)
    out = {r["day"]: r["day__oh"].toArray().tolist() for r in model.transform(train).collect()}
    assert out[1] == [0.0, 0.0]                      # the smallest category is the dropped one
    assert sorted(map(tuple, [out[2], out[10]])) == [(0.0, 1.0), (1.0, 0.0)]
    with pytest.raises(Exception):
        model.transform(spark.createDataFrame([(3,)], "day int")).collect()


def test_model_roundtrip_and_selection(spark):
    from tidemark.ml import models as mm
    rows = [(i, float(i % 28 + 1), 1, 2024, i % 7 + 1, 10.0 + i, 5.0 + (i * 7) % 11, 100.0 + 2 * i)
            for i in range(200)]
    m = spark.createDataFrame(rows, "datetime long, day double, month int, year int, day_of_week int, "
                                    "a_close double, a_volume double, t_close double")
    m = with_split(m.withColumn("day", F.col("day").cast("int")), "datetime")
    model, scored = mm.fit_and_score(m, "Linear_Regression", "t_close")
    assert mm.metrics(scored)["rmse"] < 1e-4          # t = 80 + 2*a_close exactly (labels ~1e2)
    from tidemark.session import scratch_path
    path = scratch_path(spark, "test-model")
    mm.save_model(model, path)
    again = mm.load_model(path).transform(mm.labelled(m, "t_close").filter(~F.col("is_train")))
    assert sorted(r["prediction"] for r in again.collect()) == pytest.approx(
        sorted(r["prediction"] for r in scored.collect()))
    scores = mm.compare_models(spark, m, "t_close", ["Linear_Regression", "Decision_Tree"])
    assert mm.select_best(scores).first()["best_model"] == "Linear_Regression"


CALENDAR_ROW = "day int, month int, year int, day_of_week int, a_close double"


def test_unseen_year_and_missing_value_raise(spark):
    from tidemark.ml.features import CALENDAR, OneHotVector
    train = spark.createDataFrame([(1, 1, 2019, 1, 5.0), (2, 1, 2020, 2, 6.0)], CALENDAR_ROW)
    model = OneHotVector(calendarCols=CALENDAR, inputCols=["a_close"]).fit(train)
    got = {r["year"]: r["features"].toArray().tolist() for r in model.transform(train).collect()}
    assert got == {2019: [0.0, 0.0, 0.0, 5.0], 2020: [1.0, 1.0, 1.0, 6.0]}       # one month: no slot
    for bad in [(1, 1, 2031, 1, 5.0), (1, 2, 2019, 1, 5.0), (1, 1, None, 1, 5.0), (1, 1, 2019, 1, None)]:
        row = spark.createDataFrame([bad], CALENDAR_ROW)
        assert not row.select(model.accepts(["a_close"])).first()[0]
        with pytest.raises(Exception, match="unseen category or missing value"):
            model.transform(row).collect()


def test_the_same_model_at_any_input_partitioning(spark):
    from tidemark.ml import models as mm
    rows = [(i, i % 28 + 1, 1, 2024, i % 7 + 1, 10.0 + i, float((i * 13) % 17)) for i in range(160)]
    m = with_split(spark.createDataFrame(rows, "datetime long, day int, month int, year int, day_of_week int, a_close double, t_close double"), "datetime")
    small = {"numTrees": 5, "maxDepth": 6}
    a, b = (mm.fit_and_score(m.repartition(n), "Random_Forest", "t_close", **small)[1] for n in (1, 8))
    assert sorted((r["datetime"], r["prediction"]) for r in a.collect()) == sorted((r["datetime"], r["prediction"]) for r in b.collect())


def test_defaults_are_parameters(spark):
    from tidemark.ml.models import DEFAULTS, regressor
    assert regressor("Decision_Tree").getMaxDepth() == 30 and regressor("Decision_Tree", maxDepth=3).getMaxDepth() == 3
    forest = regressor("Random_Forest")
    assert forest.getFeatureSubsetStrategy() == "all" and forest.getMaxDepth() == 30
    boosting = regressor("Gradient_Boosted_Trees")
    assert boosting.getOrDefault("rounds") == 100 and boosting.getOrDefault("depth") == 6 and "XGBoost" not in DEFAULTS


def test_metrics_of_large_prices_do_not_cancel(spark):
    from tidemark.ml.models import metrics, select_best
    rows = [(3e7 + k * 1e-3, 3e7 + k * 1e-3 + 1e-4) for k in range(100)]
    got = metrics(spark.createDataFrame(rows, "label double, prediction double"))
    assert got["r2"] == pytest.approx(1 - 1e-8 * 100 / (833.25e-6 * 100), abs=1e-3)
    scores = spark.createDataFrame([("a", float("nan")), ("b", 2.0)], "model string, rmse double")
    assert select_best(scores).first()["best_model"] == "b"
