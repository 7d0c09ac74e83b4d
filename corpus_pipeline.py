"""Corpus pipeline: from raw documents to packed windows.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``, works on all rows its
predecessor kept and returns the columns of ``documents``; the last returns the
pieces of the packed windows.

Defined results, for every stage: a null text counts as empty; a null or repeated
doc_id is no obstacle, as each row is decided by itself or named by id and digest of
its text; further columns, of any name, are kept; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, quality, queries, simhash
from tidemark.session import scratch_path
from tidemark.sources.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the graded classifier accepts; all of them if no two grades are there to fit on."""
    return quality.keep_good(docs, quality.ratings(table(spark, sf_dir, "labels")))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lowered) the row with the largest doc_id; null is lower than any, of repeated rows one stays."""
    return exact_dedup.DigestIndex(spark).keep(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id (null last), then digest; texts without words are copies of each other."""
    return simhash.keep_first(docs, shingle=4, max_bits=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; all of them if the benchmark has no words."""
    return decontaminate.keep_clean_rows(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed windows; an empty text is its end id alone."""
    return queries.pieces(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
