from pyspark.sql import functions as F

from tidemark.functions.timecols import MS_PER_DAY, MS_PER_HOUR
from tidemark.session import scratch_path
from tidemark.sources import paged as pg
from tidemark.sources.bars import bars_from_events
from tidemark.sources.replies import decode_kline_arrays, kline_array_replies
from tidemark.sources.tables import table
from tidemark.streaming.klines import run_until_done

SF = "/root/testdata/sf0.001"


def replies_of(spark, bars_per_reply=24):
    return kline_array_replies(bars_from_events(table(spark, SF, "events")), bars_per_reply=bars_per_reply)


def rows(df):
    return sorted(map(str, df.collect()))


def test_pages_are_read_back_and_filters_choose_pages(spark):
    root = scratch_path(spark, "test-pages")
    replies = replies_of(spark).cache()
    pg.land_pages(replies, root, 0)
    assert rows(pg.read_replies(spark, root)) == rows(replies.select("symbol", "window_start", "reply"))
    first = replies.agg(F.min("window_start")).first()[0]
    reader = pg.PageReader(root, 1)
    left = list(reader.pushFilters([pg.GreaterThanOrEqual(("window_start",), first + 2 * MS_PER_DAY), pg.LessThan(("window_start",), first + 9 * MS_PER_DAY),
                                    pg.In(("symbol",), ("click", "view")), pg.EqualTo(("reply",), "x")]))
    assert [f.attribute for f in left] == [("reply",)]
    pages = [p for part in reader.partitions() for p in part.pages]
    want = replies.filter(F.col("symbol").isin("click", "view") & F.col("window_start").between(first + 2 * MS_PER_DAY, first + 9 * MS_PER_DAY - 1)).count()
    assert 0 < len(pages) == want < replies.count()
    replies.unpersist()


def test_a_week_opens_only_its_pages(spark):
    root = scratch_path(spark, "test-week")
    replies = replies_of(spark)
    pg.land_pages(replies, root, 0)
    whole = decode_kline_arrays(replies)[0]
    lo = whole.agg(F.min("datetime")).first()[0] + 5 * MS_PER_DAY
    week = pg.bars_between(spark, root, lo, lo + 7 * MS_PER_DAY, page_ms=24 * MS_PER_HOUR)
    want = whole.filter(F.col("datetime").between(lo, lo + 7 * MS_PER_DAY))
    assert rows(week) == rows(want) and week.count() > 0
    # pages outside the window may be gone: they are not opened
    fs, bare = pg.pafs.FileSystem.from_uri(root)
    for page in pg.list_pages(root, [0]):
        if not lo - 24 * MS_PER_HOUR < page.window_start <= lo + 7 * MS_PER_DAY:
            with fs.open_output_stream(page.path) as f:
                f.write(b"not json")
    assert rows(pg.bars_between(spark, root, lo, lo + 7 * MS_PER_DAY, page_ms=24 * MS_PER_HOUR)) == rows(want)


def test_a_stream_resumes_at_its_offset(spark):
    root, out = scratch_path(spark, "test-paged-stream"), scratch_path(spark, "test-paged-out")
    replies = replies_of(spark).cache()
    late = F.col("symbol") == "click"

    def run():
        run_until_done(pg.stream_replies(spark, root).writeStream.format("parquet").option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start(out))

    pg.land_pages(replies.filter(~late), root, 0)
    run()
    assert rows(spark.read.parquet(out)) == rows(replies.filter(~late).select("symbol", "window_start", "reply"))
    run()                                                        # nothing new
    pg.land_pages(replies.filter(late), root, 1)                 # windows before the ones already read
    run()
    assert rows(spark.read.parquet(out)) == rows(replies.select("symbol", "window_start", "reply"))
    replies.unpersist()


def test_a_landing_counts_once_it_is_complete(spark):
    root = scratch_path(spark, "test-landing")
    assert pg.landings(root) == [] and pg.read_replies(spark, root).count() == 0
    pg.land_pages(replies_of(spark), root, 3)
    assert pg.landings(root) == [3]
    fs, bare = pg.pafs.FileSystem.from_uri(root)
    fs.create_dir(f"{bare}/landing=00000004/symbol=x/window_start=0", recursive=True)
    assert pg.landings(root) == [3]
