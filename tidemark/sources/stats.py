"""Statistics kept beside a table that is partitioned by month (ML4, A7, O3, F6).

* ``moments``: for each key and column of a month the count, exact sum, sum of
  squared deviations (M2), least and greatest value. They merge: sums add up, and
  M2 of a union is the parts' M2 plus each part's rows times the square of its
  mean's distance from the common mean. A summary or a scaler is a merge of a few
  rows per key, and a new month adds rows without another pass over the old ones.
* ``files``: for each file its key, least and greatest time and its rows. The latest
  n rows of every key are in few files, found without opening the others.

Both are versioned tables (``sources.versions``) by month; ``update`` replaces the
months it is given, in one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import PRICE_DECIMAL
from tidemark.sources.versions import VersionedTables, dealt

_SUM = T.DecimalType(38, 8)


def moments(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, column_name, n, total, m2, lo, hi): one aggregate with partial combine, a row for each key and column."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.sum(F.col(c).cast(PRICE_DECIMAL)).cast(_SUM).alias(f"{c}__t"), (F.var_pop(x) * F.count(x)).alias(f"{c}__m"),
                 F.min(x).alias(f"{c}__lo"), F.max(x).alias(f"{c}__hi")]
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").alias(name) for s, name in (("n", "n"), ("t", "total"), ("m", "m2"), ("lo", "lo"), ("hi", "hi"))])
                               for c in columns])).alias("r")
    return rows.groupBy(*keys).agg(*aggs).select(*keys, each).select(*keys, "r.*")


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Moments of the union of parts: (keys, column_name, n, mean, m2, lo, hi)."""
    whole = Window.partitionBy(*keys, "column_name")                   # a row for each part
    mean = F.sum("total").over(whole).cast("double") / F.sum("n").over(whole)
    off = F.try_divide(F.col("total").cast("double"), F.col("n")) - F.col("mean")
    return (parts.withColumn("mean", mean).groupBy(*keys, "column_name")
            .agg(F.sum("n").alias("n"), F.max("mean").alias("mean"), F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))


def summary(parts: DataFrame, key: str) -> DataFrame:
    """(key, column_name, count, mean, stddev, min, max) from stored moments."""
    return merged(parts, [key]).select(key, "column_name", F.col("n").alias("count"), "mean", F.round(F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1)), 6).alias("stddev"),
                                       F.col("lo").alias("min"), F.col("hi").alias("max"))


def population(parts: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population std of every column, a row for each on the driver."""
    rows = merged(parts.withColumn("all", F.lit(0)), ["all"]).select("column_name", "mean", F.sqrt(F.try_divide(F.col("m2"), F.col("n"))).alias("std")).collect()
    return {r["column_name"]: (r["mean"], r["std"]) for r in rows}


def newest_files(files: DataFrame, key: str, n: int) -> DataFrame:
    """Files that hold the latest ``n`` rows of every key: a file's least time is a
    bound if it and the files that begin later hold n rows; what ends before it is out."""
    later = Window.partitionBy(key).orderBy(F.col("lo").desc(), "path").rowsBetween(Window.unboundedPreceding, 0)      # a row for each file
    bounds = (files.withColumn("held", F.sum("rows").over(later)).groupBy(key).agg(F.max(F.when(F.col("held") >= n, F.col("lo"))).alias("bound")))
    return files.join(bounds, key).where(F.col("bound").isNull() | (F.col("hi") >= F.col("bound"))).drop("bound")


class StoreStats:
    """Moments and file index of the table under ``path``, partitioned by ``month`` (and others)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, month: str, keys: list[str], columns: list[str], time: str):
        self.spark, self.path, self.schema, self.month, self.keys, self.columns, self.time = spark, path, schema, month, keys, columns, time
        self.tables = VersionedTables(spark, f"{path}/_stats", {"moments": month, "files": month})
        own = [schema[k] for k in keys]
        at = T.StructField(month, schema[month].dataType)
        self.moment_schema = T.StructType([*own, T.StructField("column_name", T.StringType()), T.StructField("n", T.LongType()), T.StructField("total", _SUM),
                                           *[T.StructField(c, T.DoubleType()) for c in ("m2", "lo", "hi")], at])
        self.file_schema = T.StructType([*own, T.StructField("path", T.StringType()), *[T.StructField(c, T.LongType()) for c in ("lo", "hi", "rows")], at])

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def update(self, months: list[int] | None = None) -> None:
        """Replace the statistics of ``months`` (default: all that the table has)."""
        state, rows = self.tables.state(), self.rows()
        if months is None:
            months = [r[0] for r in rows.select(self.month).distinct().collect()]          # a row for each month
        if not months:
            return
        own = rows.filter(F.col(self.month).isin(months))
        sums = moments(own, [*self.keys, self.month], self.columns).select(*self.moment_schema.fieldNames())
        files = (own.select(*self.keys, self.month, self.time, F.col("_metadata.file_path").alias("path")).groupBy(*self.keys, self.month, "path")
                 .agg(F.min(self.time).alias("lo"), F.max(self.time).alias("hi"), F.count(F.lit(1)).alias("rows")).select(*self.file_schema.fieldNames()))
        after = {}
        for name, made, spread in (("moments", sums, [*self.keys, "column_name"]), ("files", files, ["path"])):
            after[name] = self.tables.replaced(state.tables.get(name, {}), self.tables.write(name, dealt(made, self.month, spread, 1)), months)
        self.tables.commit(state, after)

    def moments(self) -> DataFrame:
        return self.tables.read("moments", self.moment_schema)

    def files(self) -> DataFrame:
        return self.tables.read("files", self.file_schema)

    def latest(self, key: str, n: int) -> DataFrame:
        """The table's rows in the files that hold the latest ``n`` rows of every key; no other file is listed or opened."""
        paths = [r["path"] for r in newest_files(self.files(), key, n).select("path").distinct().collect()]        # as many files as n rows of each key fill
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)
