"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
TEXT_BYTES = 4 << 20    # text that a task turns into Python objects at once


def text_or_empty(column: str | Column) -> Column:
    """The column as string; null counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z lowered, every other character untouched."""
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id long, text string); extra columns of any name stay out of the plan."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write once to the shared scratch folder and go on from the files: a lost
    executor never recomputes what stands before, later passes read columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and bare path of a URI or an absolute path (file, hdfs, s3, gs)."""
    return pafs.FileSystem.from_uri(path)


def write_file(path: str, attempt: str, chunks: Iterable[bytes]) -> int:
    """Write under a temporary name beside ``path``, then rename into place.
    A repeated task writes the same bytes to the same final name."""
    fs, bare = open_fs(path)
    folder, name = posixpath.split(bare)
    fs.create_dir(folder, recursive=True)
    temp, size = f"{folder}/.{name}.{attempt}.tmp", 0
    with fs.open_output_stream(temp, compression=None) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    fs.move(temp, bare)
    return size


def ragged_gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``flat[s:s+n]`` over all (s, n)."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def runs(lengths: np.ndarray) -> np.ndarray:
    """Offsets (n + 1) of consecutive runs of the given lengths."""
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def binary_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow binary array whose i-th value holds ``values[offsets[i]:offsets[i+1]]`` as bytes."""
    values = np.ascontiguousarray(values)
    ends = np.asarray(offsets, dtype=np.int64) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1,
                                            [None, pa.py_buffer(ends), pa.py_buffer(values)]).cast(pa.binary())


def text_batches(batches: Iterator[pa.RecordBatch], limit: int = TEXT_BYTES, column: str | int = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text (one row at
    least), so a task's memory does not follow the length of the texts."""
    for batch in batches:
        at = runs(pc.binary_length(batch[column]).fill_null(0).to_numpy())
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(at, at[a] + limit, "right")) - 1)
            yield batch.slice(a, b - a)
            a = b
        pa.default_memory_pool().release_unused()


def filter_texts(docs: DataFrame, judge: Callable[[], Callable[[list[str]], np.ndarray]]) -> DataFrame:
    """The rows of ``docs`` whose text is accepted, with all their columns: each row
    is decided by itself, in one pass and without its id. ``judge`` is called once
    in a task and gives a function from texts to booleans; a null text is empty."""
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accept = judge()
        for batch in text_batches(batches, column=at):
            yield batch.filter(pa.array(accept(pc.fill_null(batch[at], "").to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def batches_of(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` with about ``limit`` characters each (one text at least)."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
