"""Reading the given parquet tables with their declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; column pruning and filters reach the parquet scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_with_schema(spark: SparkSession, path: str, fmt: str, schema: StructType | str, **options: str) -> DataFrame:
    """Files of any built-in format with a declared schema: nothing is inferred, a
    malformed record fails the job unless ``options`` set another mode."""
    return spark.read.format(fmt).schema(schema).options(**{"mode": "FAILFAST", **options}).load(path)
