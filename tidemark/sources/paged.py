"""Paged history replies as a data source (S1, S3, K1), batch and stream.

The exchange's history comes in pages: one reply for each (symbol, window) of the
chunk plan. Landed pages lie under
``<root>/landing=<number>/symbol=<symbol>/window_start=<ms>/``, one landing for each
fetch run; a landing counts once its ``_SUCCESS`` file is there.

``paged_replies`` reads them as (symbol, window_start, reply): the pages are the
source's partitions, so a filter on symbol or window_start is pushed to the list of
pages and no other page is opened. As a stream its offset is the landing number:
a micro-batch reads the pages of the landings since the last one, and a restart goes
on at the offset in the checkpoint, whatever windows a later landing fills in.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
                                    LessThan, LessThanOrEqual)
from pyspark.sql.types import StructType

from tidemark.functions.timecols import MS_PER_HOUR
from tidemark.sources.replies import BARS_PER_REPLY, decode_kline_arrays

NAME = "paged_replies"
SCHEMA = "symbol string, window_start long, reply string"
PAGES_PER_TASK = 16
PAGE_MS = MS_PER_HOUR * BARS_PER_REPLY


@dataclass(frozen=True)
class Page:
    landing: int
    symbol: str | None
    window_start: int
    path: str


class Pages(InputPartition):
    """Pages that one task reads."""

    def __init__(self, pages: list[Page]):
        self.pages = pages


def _value(part: str) -> str | None:
    text = unquote(part.split("=", 1)[1])
    return None if text == "__HIVE_DEFAULT_PARTITION__" else text


def landings(root: str) -> list[int]:
    """Numbers of the complete landings."""
    fs, bare = pafs.FileSystem.from_uri(root)
    found = fs.get_file_info(pafs.FileSelector(bare, allow_not_found=True))
    numbers = [int(f.base_name[8:]) for f in found if f.base_name.startswith("landing=")]
    marks = fs.get_file_info([f"{bare}/landing={n:08d}/_SUCCESS" for n in numbers])
    return sorted(n for n, m in zip(numbers, marks) if m.type == pafs.FileType.File)


def list_pages(root: str, numbers: Iterable[int]) -> list[Page]:
    """All pages of the given landings, from the folders' names alone."""
    fs, bare = pafs.FileSystem.from_uri(root)
    pages = []
    for n in numbers:
        for f in fs.get_file_info(pafs.FileSelector(f"{bare}/landing={n:08d}", recursive=True)):
            if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")):
                window = posixpath.dirname(f.path)
                pages.append(Page(n, _value(posixpath.basename(posixpath.dirname(window))), int(_value(posixpath.basename(window))), f.path))
    return sorted(pages, key=lambda p: (p.landing, p.symbol is not None, p.symbol or "", p.window_start, p.path))


def read_pages(root: str, pages: list[Page]) -> Iterator[tuple]:
    fs, _ = pafs.FileSystem.from_uri(root)
    for page in pages:
        with fs.open_input_stream(page.path) as f:
            for line in f.read().decode().splitlines():
                yield page.symbol, page.window_start, line


def _shared_out(pages: list[Page], pages_per_task: int) -> list[Pages]:
    return [Pages(pages[k:k + pages_per_task]) for k in range(0, len(pages), pages_per_task)] or [Pages([])]


class PageReader(DataSourceReader):
    def __init__(self, root: str, pages_per_task: int):
        self.root, self.pages_per_task = root, pages_per_task
        self.low, self.high, self.symbols = None, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Bounds of window_start and sets of symbols choose pages; the rest is left to Spark."""
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("window_start",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    low = f.value + isinstance(f, GreaterThan)
                    self.low = low if self.low is None else max(self.low, low)
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    high = f.value - isinstance(f, LessThan)
                    self.high = high if self.high is None else min(self.high, high)
            elif column == ("symbol",) and isinstance(f, (EqualTo, In)):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.symbols = own if self.symbols is None else self.symbols & own
            else:
                yield f

    def wanted(self, page: Page) -> bool:
        return ((self.low is None or page.window_start >= self.low) and (self.high is None or page.window_start <= self.high)
                and (self.symbols is None or page.symbol in self.symbols))

    def partitions(self) -> list[Pages]:
        return _shared_out([p for p in list_pages(self.root, landings(self.root)) if self.wanted(p)], self.pages_per_task)

    def read(self, partition: Pages) -> Iterator[tuple]:
        return read_pages(self.root, partition.pages)


class PageStreamReader(DataSourceStreamReader):
    def __init__(self, root: str, pages_per_task: int):
        self.root, self.pages_per_task = root, pages_per_task

    def initialOffset(self) -> dict:
        return {"landing": -1}

    def latestOffset(self) -> dict:
        known = landings(self.root)
        return {"landing": known[-1] if known else -1}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        new = [n for n in landings(self.root) if start["landing"] < n <= end["landing"]]
        return _shared_out(list_pages(self.root, new), self.pages_per_task)

    def read(self, partition: Pages) -> Iterator[tuple]:
        return read_pages(self.root, partition.pages)

    def commit(self, end: dict) -> None:
        """Pages stay where they are: the batch reader reads them too."""


class PagedReplies(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def _own(self) -> tuple[str, int]:
        return self.options["path"], int(self.options.get("pages_per_task", PAGES_PER_TASK))

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(*self._own())

    def streamReader(self, schema: StructType) -> PageStreamReader:
        return PageStreamReader(*self._own())


def _registered(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedReplies)
    return spark


def land_pages(replies: DataFrame, root: str, landing: int) -> None:
    """Write replies (symbol, window_start, reply) as the pages of one landing."""
    (replies.select("symbol", "window_start", F.col("reply").alias("value")).write.partitionBy("symbol", "window_start").text(f"{root}/landing={landing:08d}"))


def read_replies(spark: SparkSession, root: str) -> DataFrame:
    return _registered(spark).read.format(NAME).option("path", root).load()


def stream_replies(spark: SparkSession, root: str) -> DataFrame:
    return _registered(spark).readStream.format(NAME).option("path", root).load()


def bars_between(spark: SparkSession, root: str, lo: int, hi: int, page_ms: int = PAGE_MS) -> DataFrame:
    """Bars with ``lo <= datetime <= hi``: only pages whose window touches that span are opened."""
    pages = read_replies(spark, root).filter((F.col("window_start") > lo - page_ms) & (F.col("window_start") <= hi))
    return decode_kline_arrays(pages)[0].filter(F.col("datetime").between(lo, hi))
