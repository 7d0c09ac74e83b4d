from pyspark.sql import functions as F

from tidemark.sources import replies as rp

# Golden sample reply row (fixed values from the exchange's documented format).
GOLDEN = ('[[1691110800000,"29232.95000000","29234.00000000","29191.04000000","29198.15000000",'
          '"403.83160000",1691114399999,"11796663.45082500",12615,"149.50490000","4367363.99456860","0"]]')


def test_kline_array_golden_row(spark):
    replies = spark.createDataFrame([("BTCUSDT", 0, GOLDEN)], "symbol string, window_start long, reply string")
    good, bad = rp.decode_kline_arrays(replies)
    r = good.collect()[0]
    assert bad.count() == 0
    assert (r["datetime"], r["open"], r["close"], r["close_time"], r["nbr_trades"]) == (
        1691110800000, 29232.95, 29198.15, 1691114399999, 12615)
    assert r["qav"] == 11796663.450825 and r["taker_quote_vol"] == 4367363.9945686
    assert (r["year"], r["month"], r["day"], r["day_of_week"]) == (2023, 8, 4, 5)  # a Friday
    assert "unused_field" not in good.columns


def test_tolerant_decode_keeps_good_replies(spark):
    replies = spark.createDataFrame(
        [("A", 0, GOLDEN), ("B", 0, '{"code":-1121,"msg":"Invalid symbol."}'), ("C", 0, GOLDEN[:-5])],
        "symbol string, window_start long, reply string")
    good, bad = rp.decode_kline_arrays(replies)
    assert [r["market"] for r in good.collect()] == ["A"]
    assert sorted(r["symbol"] for r in bad.collect()) == ["B", "C"]


def test_kline_message_case_only_keys(spark):
    msg = ('{"e":"kline","E":1700000000500,"s":"BTCEUR","k":{"t":1700000000000,"T":1700000000999,'
           '"o":"1.5","c":"2.5","h":"3.0","l":"1.0","v":"10.0","n":7,"x":true,"q":"20.0",'
           '"V":"4.0","Q":"8.0"}}')
    out = rp.decode_kline_messages(spark.createDataFrame([(msg,), ("not json",)], "value string")).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["start_timestamp"], r["close_timestamp"]) == (1700000000000, 1700000000999)
    assert (r["volume"], r["taker_base_vol"], r["qav"], r["taker_quote_vol"]) == (10.0, 4.0, 20.0, 8.0)
    assert r["nbr_trades"] == 7 and r["symbol"] == "BTCEUR"
    assert str(r["event_date"]) == "2023-11-14 22:13:20.500000"


def test_dirty_field_becomes_null(spark):
    msg = '{"E":1,"s":"X","k":{"t":1,"T":2,"o":"abc","c":"2","h":"2","l":"2","v":"1","n":"x"}}'
    r = rp.decode_kline_messages(spark.createDataFrame([(msg,)], "value string")).collect()[0]
    assert r["open"] is None and r["nbr_trades"] is None and r["close"] == 2.0


def test_market_list_and_prefix(spark):
    reply = '{"serverTime": 5, "symbols": [{"symbol": "BTCUSDT"}, {"symbol": "ETHBTC"}, {"symbol": "BTCEUR"}]}'
    syms = rp.decode_market_list(spark.createDataFrame([(reply,)], "reply string"))
    assert sorted(r["symbol"] for r in rp.symbols_with_prefix(syms, "BTC").collect()) == ["BTCEUR", "BTCUSDT"]


def test_balances_filter(spark):
    reply = ('{"account": 1, "balances": [{"asset": "BNB", "free": "1000.00000000", "locked": "0.00000000"},'
             '{"asset": "BTC", "free": "1.00000000", "locked": "0.50000000"},'
             '{"asset": "USDT", "free": "10000.00000000", "locked": "0.00000000"}]}')
    out = rp.balances_for_assets(spark.createDataFrame([(reply,)], "reply string"), ["BTC", "USDT"])
    assert sorted((r["asset"], r["free"], r["locked"]) for r in out.collect()) == [
        ("BTC", 1.0, 0.5), ("USDT", 10000.0, 0.0)]


def test_price_snapshot_roundtrip(spark):
    ev = spark.createDataFrame([(1, "BTCEUR", 26931.6484111)], "event_id long, event_type string, value double")
    ev = ev.withColumn("ts", F.lit("2023-08-02 16:07:01").cast("timestamp_ntz"))
    r = rp.decode_price_snapshots(rp.price_snapshot_records(ev)).collect()[0]
    assert (r["currency"], r["snapshot_date"], r["snapshot_time"], r["price"]) == (
        "BTCEUR", "2023-08-02", "16:07:01", 26931.6484111)


def test_short_inner_array_does_not_fail_the_job(spark):
    reply = '[[1691110800000,"1.0"],' + GOLDEN[1:]
    good, bad = rp.decode_kline_arrays(spark.createDataFrame([("A", 0, reply)], "symbol string, window_start long, reply string"))
    rows = sorted(good.collect(), key=lambda r: r["datetime"])
    assert bad.count() == 0 and len(rows) == 2
    assert rows[0]["open"] == 1.0 and rows[0]["close"] is None


def test_malformed_snapshot_time_is_null(spark):
    recs = spark.createDataFrame(
        [(1, '{"Currency":"X","date":"2023-13-45","time":"16:07:01","price":"1.5"}')], "event_id long, record string")
    r = rp.decode_price_snapshots(recs).collect()[0]
    assert r["snapshot_ts"] is None and r["price"] == 1.5


def test_trades_reply_decode(spark):
    # two recorded trades (fixed sample values)
    reply = ('[{"symbol": "BTCUSDT", "id": 339393, "orderId": 1967061, "orderListId": -1, "price": "27496.98000000", '
             '"qty": "0.01000000", "quoteQty": "274.96980000", "commission": "0.00000000", "commissionAsset": "BTC", '
             '"time": 1696863456261, "isBuyer": true, "isMaker": false, "isBestMatch": true},'
             '{"symbol": "BTCUSDT", "id": 340144, "orderId": 1969225, "orderListId": -1, "price": "28206.43000000", '
             '"qty": "0.00100000", "quoteQty": "28.20643000", "commission": "0.00000000", "commissionAsset": "BTC", '
             '"time": 1696866465324, "isBuyer": true, "isMaker": false, "isBestMatch": true}]')
    rows = sorted(rp.decode_trades(spark.createDataFrame([(reply,)], "reply string")).collect(),
                  key=lambda r: r["trade_id"])
    assert [(r["trade_id"], r["price"], r["qty"], r["quote_qty"]) for r in rows] == [
        (339393, 27496.98, 0.01, 274.9698), (340144, 28206.43, 0.001, 28.20643)]
    assert rows[0]["is_buyer"] and not rows[0]["is_maker"] and rows[0]["commission_asset"] == "BTC"
    assert str(rows[1]["trade_time"]) == "2023-10-09 15:47:45.324000"


def tagged(spark, texts, tag, **kw):
    """(reason, raw) of the rejects and the number of decoded rows."""
    good, bad = rp.split(tag(spark.createDataFrame([(t,) for t in texts], "reply string"), **kw))
    return sorted((r["reason"], r["raw"]) for r in bad.collect()), good.count()


def test_rejected_messages_keep_their_text_and_reason(spark):
    good = '{"E":1,"s":"X","k":{"t":1}}'
    texts = [good, good[:12], '{"s":"X","k":{}}', '{"E":"soon","k":{}}', '{"E":1}', '{"E":1,"k":"none"}', "", None, "[]"]
    bad, n = tagged(spark, texts, rp.tag_kline_messages, text_col="reply")
    assert n == 1 and len(bad) == len(texts) - 1
    assert dict((raw, reason) for reason, raw in bad if raw) == {
        good[:12]: "unreadable", '{"s":"X","k":{}}': "E missing", '{"E":"soon","k":{}}': "E of wrong type", '{"E":1}': "k missing",
        '{"E":1,"k":"none"}': "field of wrong type", "[]": dict((raw, reason) for reason, raw in bad)["[]"]}
    assert ("no text", "") in bad


def test_rejected_trades_market_lists_and_balances(spark):
    trade = '{"symbol":"A","id":1,"time":5,"price":"1.5"}'
    bad, n = tagged(spark, [f"[{trade},{trade}]", "[]", '{"code":-1121,"msg":"no"}', f"[{trade}", f'[{trade},{{"symbol":"B"}}]', None], rp.tag_trades)
    assert n == 3 and [r for r, _ in bad] == ["id or time missing", "no list", "no text", "unreadable"]
    bad, n = tagged(spark, ['{"serverTime":5,"symbols":[{"symbol":"A"},{"status":"x"}]}', '{"serverTime":5,"symbols":[]}', '{"symbols":[]}', '{"serverTime":5}', "{", None], rp.tag_market_list)
    assert n == 1 and [r for r, _ in bad] == ["no text", "serverTime missing", "symbol missing", "symbols missing", "unreadable"]
    bad, n = tagged(spark, ['{"account":1,"balances":[{"asset":"A","free":"1"},{"free":"2"}]}', '{"account":"x","balances":[]}', '{"code":1}', "x"], rp.tag_balances)
    assert n == 1 and [r for r, _ in bad] == ["account missing", "account of wrong type", "asset missing", "unreadable"]
