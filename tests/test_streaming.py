import pytest
from pyspark.sql import functions as F

from tidemark.operators.matrix import wide_enrich
from tidemark.operators.windows import trailing_mean_range
from tidemark.sources.bars import bars_from_events
from tidemark.sources.replies import decode_kline_messages, kline_messages
from tidemark.sources.tables import table
from tidemark.sources.versions import VersionConflict
from tidemark.streaming import klines as sk

SF = "/root/testdata/sf0.001"
DRIVER, OTHERS = "click", ["purchase", "signup", "error"]


def batch_result(spark):
    long = decode_kline_messages(kline_messages(bars_from_events(table(spark, SF, "events"))))
    avg = trailing_mean_range(long, "symbol", "event_timestamp", "close", sk.WEEK_MS, "rolling_avg_7d")
    wide = wide_enrich(avg.withColumnRenamed("symbol", "market"), DRIVER, OTHERS, key="event_timestamp", monday=0)
    return avg, wide.withColumnRenamed("event_timestamp", "start_timestamp")


def stored(spark, paths):
    """All copies in the append query's history."""
    return sk.append_tables(spark, paths).read("market", sk.MARKET)


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_replay_equals_batch_and_rerun_is_idempotent(spark):
    paths = sk.new_paths(spark, "test-stream")
    msgs = kline_messages(bars_from_events(table(spark, SF, "events")))
    sk.land_messages(msgs, paths.landing, files=3)
    sk.run_until_done(sk.wide_upsert_query(spark, paths, DRIVER, OTHERS))
    avg, wide = batch_result(spark)
    cols_a = ["symbol", "event_timestamp", "close", "rolling_avg_7d"]
    got_avg = sk.read_averages(spark, paths)
    assert rows(got_avg, cols_a) == rows(avg, cols_a)
    cols_w = sorted(wide.columns)
    got_wide = sk.read_wide(spark, paths, DRIVER, OTHERS)
    assert rows(got_wide, cols_w) == rows(wide, cols_w)


def test_batch_body_replay_is_idempotent_and_order_free(spark):
    paths = sk.new_paths(spark, "test-replay")
    msgs = kline_messages(bars_from_events(table(spark, SF, "events"))).cache()
    part = F.abs(F.hash("value")) % 2
    early, late = msgs.filter(part == 0), msgs.filter(part == 1)
    body = sk.WideUpsert(sk.wide_tables(spark, paths), DRIVER, OTHERS)
    body(late, 0)
    body(early, 1)
    body(late, 0)          # restart after a failure re-delivers batch 0
    _, wide = batch_result(spark)
    cols_w = sorted(wide.columns)
    history = sk.wide_tables(spark, paths).read("market", sk.MARKET)
    assert history.groupBy("symbol", "event_timestamp").count().filter(F.col("count") > 1).count() == 0
    assert rows(sk.read_wide(spark, paths, DRIVER, OTHERS), cols_w) == rows(wide, cols_w)
    msgs.unpersist()


def test_append_sink_exactly_once(spark):
    paths = sk.new_paths(spark, "test-append")
    msgs = kline_messages(bars_from_events(table(spark, SF, "events")))
    sk.land_messages(msgs, paths.landing, files=2)
    sk.run_until_done(sk.append_market_query(spark, paths))
    sk.run_until_done(sk.append_market_query(spark, paths))   # restart: nothing new to add
    assert stored(spark, paths).count() == msgs.count()


def test_redelivered_messages_count_once(spark):
    paths = sk.new_paths(spark, "test-redeliver")
    msgs = kline_messages(bars_from_events(table(spark, SF, "events"))).cache()
    part = F.abs(F.hash("value")) % 3
    body = sk.WideUpsert(sk.wide_tables(spark, paths), DRIVER, OTHERS)
    body(msgs.filter(part != 0), 0)
    body(msgs.filter(part != 1), 1)          # two thirds of these were already delivered
    avg, wide = batch_result(spark)
    cols_a = ["symbol", "event_timestamp", "close", "rolling_avg_7d"]
    assert rows(sk.read_averages(spark, paths), cols_a) == rows(avg, cols_a)
    cols_w = sorted(wide.columns)
    assert rows(sk.read_wide(spark, paths, DRIVER, OTHERS), cols_w) == rows(wide, cols_w)
    msgs.unpersist()


def test_stream_scoring_equals_batch_scoring(spark):
    from tidemark.ml import models as mm
    from tidemark.plans import catalog as c
    from tidemark.operators.serving import daily_requests
    from tidemark.streaming.scoring import rejected_stream, score_stream
    from tidemark.session import scratch_path
    sf = "/root/testdata/sf0.01"          # sf0.001 has no hour with all five markets
    data = mm.labelled(c.split_matrix(spark, sf), c.TARGET_COL)
    model = mm.model_pipeline("Linear_Regression", data.columns, c.TARGET_COL).fit(data.filter("is_train"))
    req = daily_requests(c.q_driver_left_enrich(spark, sf), c.FEATURE_MARKETS)
    root = scratch_path(spark, "test-score")
    req.repartition(3).write.json(f"{root}/requests")
    q = (score_stream(spark, model, f"{root}/requests", c.FEATURE_MARKETS, c.BUY_LIMIT)
         .writeStream.format("parquet").option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start(f"{root}/scored"))
    sk.run_until_done(q)
    got = {r["request_day_ms"]: r["prediction"] for r in spark.read.parquet(f"{root}/scored").collect()}
    want = {r["request_day_ms"]: r["prediction"]
            for r in model.transform(req.withColumn("day_of_week", F.col("day_of_week") + 1).where(mm.accepts(model))).collect()}
    assert got.keys() == want.keys()
    q = (rejected_stream(spark, model, f"{root}/requests", c.FEATURE_MARKETS)
         .writeStream.format("parquet").option("checkpointLocation", f"{root}/ckpt-rejects")
         .trigger(availableNow=True).start(f"{root}/rejects"))
    sk.run_until_done(q)
    rejects = {r["request_day_ms"] for r in spark.read.parquet(f"{root}/rejects").collect()}
    assert rejects and rejects.isdisjoint(got) and len(rejects) + len(got) == req.count()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_timed_run_stops_and_keeps_progress(spark):
    # K1/K5: a processing-time trigger stopped after a fixed duration
    paths = sk.new_paths(spark, "test-timed")
    sk.land_messages(kline_messages(bars_from_events(table(spark, SF, "events"))), paths.landing, files=2)
    q = sk.append_market_query(spark, paths, trigger_once=False)
    sk.run_until_done(q, timeout_s=20)
    assert not q.isActive
    assert stored(spark, paths).count() > 0


def test_redelivered_messages_are_read_once_whatever_their_delay(spark):
    paths = sk.new_paths(spark, "test-dedup")
    msgs = kline_messages(bars_from_events(table(spark, SF, "events")))
    sk.land_messages(msgs, paths.landing, files=1)
    sk.land_messages(msgs, paths.landing, files=1, mode="append")   # every message delivered twice
    sk.run_until_done(sk.append_market_query(spark, paths, files_per_trigger=1))
    got = sk.read_market(spark, paths)
    assert stored(spark, paths).count() == 2 * msgs.count()
    assert got.count() == msgs.count() == got.select("symbol", "event_timestamp").distinct().count()


def test_a_correction_in_the_same_batch_replaces_the_message(spark):
    day = 20_000 * sk.MS_PER_DAY
    history = spark.createDataFrame([("a", day, 1.0, 0, 0), ("a", day, 2.0, 0, 5), ("a", day, 3.0, 0, 2), ("b", day, 9.0, 1, 0), ("b", day, 8.0, 0, 7)],
                                    "symbol string, event_timestamp long, close double, batch_id long, arrival long")
    for n in (1, 3):
        got = {r["symbol"]: r["close"] for r in sk.latest_per_message(history.repartition(n)).collect()}
        assert got == {"a": 2.0, "b": 9.0}


def test_a_very_late_row_touches_only_its_own_days(spark):
    paths = sk.new_paths(spark, "test-late")
    bars = bars_from_events(table(spark, SF, "events")).cache()
    first = bars.agg(F.min("datetime")).first()[0]
    late = bars.filter(F.col("datetime") == first).limit(1)
    tables = sk.wide_tables(spark, paths)
    body = sk.WideUpsert(tables, DRIVER, OTHERS, length_ms=2 * sk.MS_PER_DAY)
    body(kline_messages(bars.join(late.select("market", "datetime"), ["market", "datetime"], "left_anti")), 0)
    before = tables.state().tables["averages"]
    body(kline_messages(late), 1)
    after = tables.state().tables["averages"]
    changed = {int(d) for d in after if after[d] != before.get(d)}
    own = late.first()["close_time"] // sk.MS_PER_DAY
    assert changed and changed <= {own, own + 1, own + 2} and len(after) > 5
    bars.unpersist()


def messages_of_days(spark):
    """Messages in four parts by time."""
    bars = bars_from_events(table(spark, SF, "events")).cache()
    day = F.col("datetime") / sk.MS_PER_DAY
    lo, hi = bars.agg(F.min(day), F.max(day)).first()
    return [kline_messages(bars.filter(F.least(F.floor((day - lo) / (hi - lo) * 4), F.lit(3)) == k)) for k in range(4)]


def test_a_reader_sees_only_the_version_it_started_from(spark):
    paths = sk.new_paths(spark, "test-versions")
    body = sk.WideUpsert(sk.wide_tables(spark, paths), DRIVER, OTHERS)
    parts = messages_of_days(spark)
    body(parts[0], 0)
    avg, wide = sk.read_averages(spark, paths), sk.read_wide(spark, paths, DRIVER, OTHERS)
    n_avg, n_wide = avg.count(), wide.count()
    body(parts[1], 1)
    body(parts[2], 2)
    assert (avg.count(), wide.count()) == (n_avg, n_wide)                     # started before the commits
    assert sk.read_averages(spark, paths).count() > n_avg
    old = body.tables.read("averages", sk.AVERAGES, body.tables.state(1))
    assert old.count() == n_avg and body.tables.versions()[:3] == [1, 2, 3]


def test_a_batch_that_dies_before_its_commit_leaves_no_trace(spark, monkeypatch):
    paths = sk.new_paths(spark, "test-dies")
    body = sk.WideUpsert(sk.wide_tables(spark, paths), DRIVER, OTHERS)
    parts = messages_of_days(spark)
    body(parts[0], 0)
    before = rows(sk.read_wide(spark, paths, DRIVER, OTHERS), ["start_timestamp"])
    monkeypatch.setattr(body.tables, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        body(parts[1], 1)
    monkeypatch.undo()
    assert rows(sk.read_wide(spark, paths, DRIVER, OTHERS), ["start_timestamp"]) == before
    body(parts[1], 1)
    assert len(sk.read_wide(spark, paths, DRIVER, OTHERS).collect()) > len(before)
    assert body.tables.vacuum(keep=1) > 0                                     # what the dead batch wrote, and the old version
    assert len(sk.read_wide(spark, paths, DRIVER, OTHERS).collect()) > len(before)


def test_the_second_writer_of_a_version_fails(spark):
    tables = sk.wide_tables(spark, sk.new_paths(spark, "test-conflict"))
    base = tables.state()
    tables.commit(base, {"wide": {"1": ["a"]}})
    with pytest.raises(VersionConflict):
        tables.commit(base, {"wide": {"1": ["b"]}})
    assert tables.state().tables == {"wide": {"1": ["a"]}} and tables.versions() == [1]


def test_days_of_many_batches_are_compacted(spark, monkeypatch):
    monkeypatch.setattr(sk, "MOST_FOLDERS", 2)
    paths = sk.new_paths(spark, "test-compact")
    body = sk.MarketAppend(sk.append_tables(spark, paths))
    msgs = kline_messages(bars_from_events(table(spark, SF, "events"))).cache()
    for k in range(6):                                      # every message in two batches
        body(msgs.filter((F.abs(F.hash("value")) % 3) == k % 3), k)
    folders = body.tables.state().tables["market"]
    assert folders and max(map(len, folders.values())) <= 2
    got = sk.read_market(spark, paths)
    assert got.count() == msgs.count() == got.select("symbol", "event_timestamp").distinct().count()
    want = decode_kline_messages(msgs)
    cols = sorted(want.columns)
    assert rows(got, cols) == rows(want, cols)
    msgs.unpersist()


def test_rejects_are_stored_once_with_their_batch(spark):
    paths = sk.new_paths(spark, "test-rejects")
    body = sk.MarketAppend(sk.append_tables(spark, paths))
    good = kline_messages(bars_from_events(table(spark, SF, "events"))).limit(5)
    bad = spark.createDataFrame([("{cut",), ('{"E":1}',), (None,)], "value string")
    body(good.unionByName(bad), 0)
    body(good.unionByName(bad), 0)                          # the batch again
    body(spark.createDataFrame([('{"k":{}}',)], "value string"), 1)
    got = sorted((r["batch_id"], r["reason"], r["raw"]) for r in sk.read_rejects(spark, paths).collect())
    assert got == [(0, "k missing", '{"E":1}'), (0, "no text", ""), (0, "unreadable", "{cut"), (1, "E missing", '{"k":{}}')]
    assert sk.read_market(spark, paths).count() == 5
