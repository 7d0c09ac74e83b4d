import pytest
from pyspark.sql import types as T

LONG_TEXT = "alpha beta gamma delta " * 20000
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("digest", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("ids", T.StringType()), T.StructField("row", T.LongType()), T.StructField("score", T.StringType()),
])
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog."),
    (2, "the QUICK brown fox jumps over the lazy dog."),
    (3, None), (4, ""), (5, "   \n\t "),
    (6, LONG_TEXT), (7, LONG_TEXT.upper()),
    (8, "<|endoftext|> is a string, it's ordinary text here"),
    (9, "Ça déjà vu — naïve café 中文   x\x1cy"),
    (9, "Ça déjà vu — naïve café 中文   x\x1cy"),       # a repeated row
    (None, "the quick brown fox jumps over the lazy dog."), (None, None),
    (10, "word"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, equal texts, repeated rows, clashing names."""
    return spark.createDataFrame([(i, t, None, "s", None, "d", "k", "f", "i", None, None) for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
