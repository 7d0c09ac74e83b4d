"""Regressors, evaluation and selection (ML5, ML7-ML14, A8-A10, S13).

Each model is one ``pyspark.ml.Pipeline``: calendar one-hot (SQLTransformer),
population standardisation of the continuous columns, assembly, regressor.
Fitting and scoring are distributed; only the metrics (a few floats per model)
come back to the driver.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorIndexer
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.ml.boosting import HistogramBoosting
from tidemark.ml.features import CALENDAR, OneHotVector, PopStandardScaler, continuous_columns
from tidemark.session import materialize, scratch_path

# Candidate models and their default parameters. Trees grow until their leaves
# are pure or MLlib's deepest level (30); forests look at every feature; boosting is
# second-order, 100 rounds of depth 6 with rate 0.3.
DEFAULTS: dict[str, dict] = {
    "Linear_Regression": {"solver": "normal"},
    "Decision_Tree": {"maxDepth": 30},
    "Random_Forest": {"maxDepth": 30, "numTrees": 100, "featureSubsetStrategy": "all"},
    "Gradient_Boosted_Trees": {"rounds": 100, "depth": 6, "rate": 0.3},
}
MODEL_NAMES = list(DEFAULTS)
_CLASSES = {"Linear_Regression": LinearRegression, "Decision_Tree": DecisionTreeRegressor,
            "Random_Forest": RandomForestRegressor, "Gradient_Boosted_Trees": HistogramBoosting}
_SEEDED = ("Decision_Tree", "Random_Forest")


def regressor(name: str, label: str = "label", seed: int = 42, features: str = "features", **params):
    """The named regressor; ``params`` override its DEFAULTS."""
    if name not in DEFAULTS:
        raise ValueError(f"unsupported model {name!r}")
    own = {**DEFAULTS[name], **params}
    if name in _SEEDED:
        own.setdefault("seed", seed)
    return _CLASSES[name](featuresCol=features, labelCol=label, **own)


def model_stages(name: str, label: str = "label", seed: int = 42, **params) -> list:
    """Estimators after the shared features. MLlib's tree models first index vector
    slots with at most 4 distinct values as categorical (ML6) — the one-hot slots."""
    if name not in _SEEDED:
        return [regressor(name, label, seed, **params)]
    return [VectorIndexer(inputCol="features", outputCol="features_idx", maxCategories=4,
                          handleInvalid="keep"),
            regressor(name, label, seed, features="features_idx", **params)]


def feature_stages(columns: list[str], target: str, key: str = "datetime"):
    """Calendar one-hot learned from the fitted rows (an unseen value raises),
    standardised continuous columns, one vector (a NULL raises)."""
    cont = continuous_columns(columns, exclude=(target, key, "label"))
    scaled = [f"{c}__z" for c in cont]
    return [PopStandardScaler(inputCols=cont, outputCols=scaled),
            OneHotVector(calendarCols=CALENDAR, inputCols=scaled, outputCol="features")]


def learned_one_hot_stages(cols: list[str], handle_invalid: str = "error"):
    """sklearn-style one-hot learned from the training data: categories ordered so
    the smallest value is last and dropped; unseen values raise on transform."""
    pad = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"lpad(CAST({c} AS STRING), 6, '0') AS {c}__s" for c in cols) + " FROM __THIS__")
    idx = StringIndexer(inputCols=[f"{c}__s" for c in cols], outputCols=[f"{c}__i" for c in cols],
                        stringOrderType="alphabetDesc", handleInvalid=handle_invalid)
    enc = OneHotEncoder(inputCols=[f"{c}__i" for c in cols], outputCols=[f"{c}__oh" for c in cols],
                        dropLast=True, handleInvalid=handle_invalid)
    return [pad, idx, enc]


def model_pipeline(name: str, columns: list[str], target: str, **params) -> Pipeline:
    return Pipeline(stages=feature_stages(columns, target) + model_stages(name, **params))


def accepts(model: PipelineModel) -> Column:
    """Whether the fitted pipeline can score a row: every feature is there and its calendar values were learned."""
    scaler, vector = model.stages[0], model.stages[1]
    return vector.accepts(scaler.getInputCols())


def labelled(matrix: DataFrame, target: str) -> DataFrame:
    return matrix.withColumn("label", F.col(target).cast("double"))


class PreparedSplit:
    """The shared preprocessor fitted once on the train rows, and both splits
    featurized once and persisted (every regressor reads the same vectors).

    The matrix is written once to the shared folder, dealt by key and sorted, so
    a fit does not depend on how its rows were partitioned before (a forest draws
    its samples by partition and place).
    """

    def __init__(self, matrix: DataFrame, target: str, key: str = "datetime"):
        self.key = key
        self.data = materialize(labelled(matrix, target).repartition(key).sortWithinPartitions(key))
        train = self.data.filter("is_train")
        self.features = Pipeline(stages=feature_stages(matrix.columns, target, key)).fit(train)
        keep = [key, "label", "features"]
        self.train = self.features.transform(train).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
        self.test = self.features.transform(self.data.filter(~F.col("is_train"))).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(self, name: str, **params) -> tuple[PipelineModel, DataFrame]:
        """The fitted pipeline and its scores of the test rows."""
        fitted = Pipeline(stages=model_stages(name, **params)).fit(self.train)
        model = PipelineModel(stages=list(self.features.stages) + list(fitted.stages))
        return model, fitted.transform(self.test)

    def close(self) -> None:
        self.train.unpersist()
        self.test.unpersist()


def fit_and_score(matrix: DataFrame, name: str, target: str, **params) -> tuple[PipelineModel, DataFrame]:
    """Fit on the hash-split train rows, score the test rows (read from the written matrix)."""
    prep = PreparedSplit(matrix, target)
    try:
        return prep.fit(name, **params)
    finally:
        prep.close()


def metrics(scored: DataFrame) -> dict[str, float]:
    """RMSE and R² in one aggregate pass (partial sums, one row back)."""
    y, e = F.col("label"), F.col("label") - F.col("prediction")
    r = scored.agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"), F.var_pop(y).alias("var")).first()
    n = r["n"] or 0
    if n == 0:
        return {"rmse": float("nan"), "r2": float("nan")}
    ss_tot = r["var"] * n                          # centred: no cancellation for large prices
    return {"rmse": (r["sse"] / n) ** 0.5, "r2": 1.0 - r["sse"] / ss_tot if ss_tot else float("nan")}


def compare_models(spark: SparkSession, matrix: DataFrame, target: str,
                   names: list[str] = MODEL_NAMES, parallelism: int = 4,
                   fitted: dict | None = None, params: dict[str, dict] | None = None,
                   scores_path: str | None = None) -> DataFrame:
    """Train every model on the same featurized split; one metrics row per model
    and the arg-min of RMSE flagged. Only the metrics reach the driver.

    Fits are submitted from ``parallelism`` driver threads (as MLlib's tuning
    estimators do), so the jobs of different models share the executors. Each
    model's scores of the test rows are written once, as partition ``model`` of the
    table (model, key, label, prediction) under ``scores_path`` (default: the shared
    folder), and the metrics are an aggregate of that table. Pass a dict as
    ``fitted`` to receive the fitted pipeline of every model by name, and
    ``params`` to override a model's DEFAULTS."""
    prep = PreparedSplit(matrix, target)
    path = scores_path or scratch_path(spark, "scores")

    def one(n: str):
        model, scored = prep.fit(n, **(params or {}).get(n, {}))
        if fitted is not None:
            fitted[n] = model
        scored.select(F.col(prep.key).alias("key"), "label", "prediction").write.parquet(f"{path}/model={n}")
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(one, names))
    finally:
        prep.close()
    return model_metrics(read_scores(spark, path))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """(model, key, label, prediction) of every candidate's test rows."""
    return spark.read.parquet(path).select("model", "key", "label", "prediction")


def model_metrics(scores: DataFrame) -> DataFrame:
    """(model, rmse, r2, is_best) from a table of scores: one partial aggregate; the
    least RMSE is the best, ties go to the first name."""
    y, e = F.col("label"), F.col("label") - F.col("prediction")
    per = scores.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"), F.var_pop(y).alias("var"))
    per = per.select("model", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"), (1 - F.try_divide(F.col("sse"), F.col("var") * F.col("n"))).alias("r2"))
    rows = [(r["model"], r["rmse"], float("nan") if r["r2"] is None else r["r2"]) for r in per.collect()]      # a row per model
    best = min(rows, key=lambda r: (math.isnan(r[1]), r[1], r[0]))[0] if rows else None      # NaN last, as min_by ranks it
    return scores.sparkSession.createDataFrame([(n, r, q, n == best) for n, r, q in rows],
                                               "model string, rmse double, r2 double, is_best boolean")


def select_best(scores: DataFrame) -> DataFrame:
    """The model with the lowest RMSE (``min_by``), as one row."""
    return scores.agg(F.min_by("model", "rmse").alias("best_model"), F.min("rmse").alias("best_rmse"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
