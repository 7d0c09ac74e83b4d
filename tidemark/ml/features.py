"""Feature preparation (ML1-ML6): stable split, one-hot of calendar columns,
population standardisation, assembly."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import FEATURE_COLUMNS, PRICE_DECIMAL

CALENDAR = ["day", "month", "year", "day_of_week"]


def split_bucket(key) -> Column:
    """0..99 from the first 32 bits of md5(key): the same in any engine and
    independent of partitioning, unlike ``randomSplit``."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    return (F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint") % F.lit(100)).cast("int")


def with_split(df: DataFrame, key: str, train_pct: int = 75) -> DataFrame:
    b = split_bucket(key)
    return df.withColumn("split_bucket", b).withColumn("is_train", F.col("split_bucket") < F.lit(train_pct))


def continuous_columns(columns: list[str], exclude: tuple[str, ...] = ()) -> list[str]:
    """Feature columns picked by name substring (P10), in frame order."""
    return [c for c in columns if c not in exclude and any(s in c for s in FEATURE_COLUMNS)]


def learned_categories(df: DataFrame, cols: list[str] = CALENDAR) -> DataFrame:
    """(column_name, category) of every value that occurs, without the smallest of
    each column (the dropped one): one aggregate, a row per distinct value."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("int").alias("category")) for c in cols]))
    seen = df.select(pairs.alias("p")).where(F.col("p.category").isNotNull()).select("p.*").distinct()
    least = seen.groupBy("column_name").agg(F.min("category").alias("least"))
    return seen.join(least, "column_name").where("category > least").select("column_name", "category")


def one_hot_long(df: DataFrame, fitted_on: DataFrame, key: str, cols: list[str] = CALENDAR) -> DataFrame:
    """(key, feature, hot) for each row and each category learned from ``fitted_on``;
    all but the smallest category of a column make a feature."""
    cats = learned_categories(fitted_on, cols).groupBy("column_name").agg(F.collect_set("category").alias("categories"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("int").alias("value")) for c in cols]))
    return (df.select(F.col(key), pairs.alias("p")).select(key, "p.*").join(F.broadcast(cats), "column_name")   # a row per calendar column
            .select(key, "column_name", "value", F.explode("categories").alias("category"))
            .select(key, F.concat_ws("_", "column_name", F.col("category").cast("string")).alias("feature"),
                    F.coalesce((F.col("value") == F.col("category")).cast("int"), F.lit(0)).alias("hot")))


def population_stats(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """mean and population std per column in one aggregate (a row of 2×cols values)."""
    aggs = []
    for c in cols:
        aggs += [(F.sum(F.col(c).cast(PRICE_DECIMAL)).cast("double") / F.count(c)).alias(f"m_{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def standardise(df: DataFrame, stats: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """(x - mean) / std, std 0 treated as 1 (a constant column maps to 0)."""
    cols = {}
    for c, (m, s) in stats.items():
        s = s if s and s > 0 else 1.0
        cols[c + suffix] = (F.col(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(cols)


class _ScalerParams(HasInputCols, HasOutputCols):
    pass


class PopStandardScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise with the mean and POPULATION std of the training frame (MLlib's
    StandardScaler uses the sample std and does not centre by default)."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopStandardScalerModel":
        ins = self.getInputCols()
        stats = population_stats(dataset, ins)
        if any(m is None for m, _ in stats.values()):
            raise ValueError("PopStandardScaler: no non-null training values (empty training split?)")
        return PopStandardScalerModel(inputCols=ins, outputCols=self.getOutputCols(),
                                      means=[stats[c][0] for c in ins],
                                      stds=[stats[c][1] or 0.0 for c in ins])


class PopStandardScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "column means", typeConverter=TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population standard deviations",
                 typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, means=None, stds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ins, outs = self.getInputCols(), self.getOutputCols()
        ms, ss = self.getOrDefault(self.means), self.getOrDefault(self.stds)
        cols = {o: (F.col(i) - F.lit(m)) / F.lit(s if s > 0 else 1.0)
                for i, o, m, s in zip(ins, outs, ms, ss)}
        return dataset.withColumns(cols)


class _VectorParams(HasInputCols, HasOutputCol):
    calendarCols = Param(Params._dummy(), "calendarCols", "integer columns to one-hot encode", typeConverter=TypeConverters.toListString)


class OneHotVector(Estimator, _VectorParams, DefaultParamsReadable, DefaultParamsWritable):
    """One dense vector: one-hot of ``calendarCols`` (categories learned from the
    fitted rows, the smallest dropped, one category alone gives no slot) and
    ``inputCols`` as they are. An unseen category or a NULL raises."""

    @keyword_only
    def __init__(self, *, calendarCols=None, inputCols=None, outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "OneHotVectorModel":
        cols = self.getOrDefault(self.calendarCols)
        # distinct calendar values: at most a few dozen per column
        row = dataset.agg(*[F.sort_array(F.collect_set(F.col(c).cast("int"))).alias(c) for c in cols]).first()
        return OneHotVectorModel(calendarCols=cols, inputCols=self.getInputCols(), outputCol=self.getOutputCol(),
                                 categories=[",".join(map(str, row[c])) for c in cols])


class OneHotVectorModel(Model, _VectorParams, DefaultParamsReadable, DefaultParamsWritable):
    categories = Param(Params._dummy(), "categories", "learned categories of each column, comma-separated",
                       typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, calendarCols=None, inputCols=None, outputCol="features", categories=None):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**self._input_kwargs)

    def _known(self) -> list[tuple[str, list[int]]]:
        return [(c, [int(x) for x in listed.split(",") if x])
                for c, listed in zip(self.getOrDefault(self.calendarCols), self.getOrDefault(self.categories))]

    def accepts(self, values: list[str]) -> Column:
        """Whether a row has learned categories and none of ``values`` is missing."""
        ok = F.lit(True)
        for c, known in self._known():
            ok = ok & (F.coalesce(F.col(c).isin(known), F.lit(False)) if known else F.lit(False))
        for c in values:
            ok = ok & F.col(c).isNotNull()
        return ok

    def _transform(self, dataset: DataFrame) -> DataFrame:
        slots = [(F.col(c) == F.lit(v)).cast("double") for c, known in self._known() for v in known[1:]]
        slots += [F.col(c).cast("double") for c in self.getInputCols()]
        message = F.concat(F.lit("unseen category or missing value in a row: "), F.to_json(F.struct(*self.getOrDefault(self.calendarCols))))
        vector = array_to_vector(F.when(self.accepts(self.getInputCols()), F.array(*slots))
                                 .otherwise(F.raise_error(message).cast("array<double>")))
        return dataset.withColumn(self.getOutputCol(), vector)


def vector_frame(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """ML1: (label, features) with the LAST of ``columns`` as the label and the
    others, in order, as a dense vector (VectorAssembler, no RDD map)."""
    from pyspark.ml.feature import VectorAssembler
    *feats, label = columns
    v = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="error").transform(df)
    return v.select(*keep, F.col(label).cast("double").alias("label"), "features")
