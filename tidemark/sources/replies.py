"""Raw exchange replies as text, and their decoders.

The decoders are the operators: text in, typed rows out, all with built-in
``from_json`` / ``explode`` / ``element_at`` / ``try_cast`` (no Python per row).
The ``*_replies`` builders turn the given tables into reply text of the same
shape the exchange sends, so the decoders always run over data that grows
with the inputs. Every builder groups by a key whose group size is bounded
(hours of one day, assets of one account, symbols of one day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timecols import MS_PER_DAY, MS_PER_HOUR, calendar_columns, epoch_us, floor_div, ms_to_ntz
from tidemark.schemas import (BALANCE_REPLY_SCHEMA, BAR_COLUMNS, KLINE_FIELDS, KLINE_MESSAGE_SCHEMA,
                              MARKET_LIST_SCHEMA, MARKET_TABLE_SCHEMA, PRICE_DECIMAL,
                              PRICE_SNAPSHOT_SCHEMA, TRADES_REPLY_SCHEMA)


# Fixed value: bars per reply page of the exchange's history endpoint.
BARS_PER_REPLY = 1000


def dec_text(c) -> Column:
    """Decimal string with 8 places, as the exchange formats prices."""
    return (F.col(c) if isinstance(c, str) else c).cast(PRICE_DECIMAL).cast("string")


def _json_str(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def _json_num(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


# --- rejects (F9, S7) --------------------------------------------------------

def _why(text: Column, required: dict[str, str | None]) -> Column:
    """Reason why a JSON object cannot be decoded: ``required`` fields must be
    there and, where a type is given, be of it. Evaluated for bad text only."""
    probe = F.from_json(text, ", ".join(f"{f} string" for f in (*required, "_corrupt_record")))
    why = F.when(text.isNull(), "no text").when(probe.isNull() | probe["_corrupt_record"].isNotNull(), "unreadable")
    for name, kind in required.items():
        why = why.when(probe[name].isNull(), f"{name} missing")
        if kind:
            why = why.when(probe[name].try_cast(kind).isNull(), f"{name} of wrong type")
    return why.otherwise("field of wrong type")


def tagged(parsed: DataFrame, good: Column, why: Column, text: str) -> DataFrame:
    """``parsed`` with ``reason`` and ``raw`` (the text as it came), both null where ``good``."""
    ok = F.coalesce(good, F.lit(False))
    return parsed.withColumns({"reason": F.when(~ok, why), "raw": F.when(~ok, F.coalesce(F.col(text), F.lit("")))})


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tagged rows → (decoded rows, rejects (reason, raw))."""
    return rows.filter(F.col("reason").isNull()).drop("reason", "raw"), rows.filter(F.col("reason").isNotNull()).select("reason", "raw")


# --- kline arrays (S1, P1-P3, F9) --------------------------------------------

def kline_array_replies(bars: DataFrame, bar_ms: int = MS_PER_HOUR,
                        bars_per_reply: int = BARS_PER_REPLY) -> DataFrame:
    """One reply per (market, request window): a JSON array of 12-element bar
    arrays mixing numbers and decimal strings. A window spans ``bars_per_reply``
    bar widths, so a reply (one ``collect_list`` group) never holds more than
    that many bars, whatever the interval. Columns: symbol, window_start, reply."""
    per_ms = bar_ms * bars_per_reply
    elem = F.concat(
        F.lit("["), _json_num(F.col("datetime")), F.lit(","),
        _json_str(dec_text("open")), F.lit(","), _json_str(dec_text("high")), F.lit(","),
        _json_str(dec_text("low")), F.lit(","), _json_str(dec_text("close")), F.lit(","),
        _json_str(dec_text("volume")), F.lit(","), _json_num(F.col("close_time")), F.lit(","),
        _json_str(dec_text("qav")), F.lit(","), _json_num(F.col("nbr_trades")), F.lit(","),
        _json_str(dec_text("taker_base_vol")), F.lit(","), _json_str(dec_text("taker_quote_vol")),
        F.lit(',"0"]'))
    return (bars.select(F.col("market").alias("symbol"),
                        (floor_div("datetime", per_ms) * F.lit(per_ms)).alias("window_start"),
                        elem.alias("e"))
            .groupBy("symbol", "window_start")
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list("e"), ","), F.lit("]")).alias("reply")))


def error_reply_for(replies: DataFrame, failing_symbol: str) -> DataFrame:
    """Replies of ``failing_symbol`` replaced by the exchange's error object."""
    err = F.lit('{"code":-1121,"msg":"Invalid symbol."}')
    return replies.withColumn("reply", F.when(F.col("symbol") == failing_symbol, err)
                              .otherwise(F.col("reply")))


def decode_kline_arrays(replies: DataFrame, zone: str = "UTC") -> tuple[DataFrame, DataFrame]:
    """Replies → (bars, failed replies).

    A reply that is not an array of arrays (error object, truncated text) parses
    to NULL; it goes to the side output instead of failing the job, and every
    other reply is kept (the skip-and-continue rule of the fetch loop).
    """
    parsed = replies.withColumn("_rows", F.from_json("reply", "array<array<string>>"))
    failed = parsed.filter(F.col("_rows").isNull()).drop("_rows")
    rows = parsed.filter(F.col("_rows").isNotNull()).select(
        F.col("symbol").alias("market"), F.explode("_rows").alias("a"))
    typed = {"datetime": "bigint", "close_time": "bigint", "nbr_trades": "bigint"}
    # try_element_at: a short inner array gives NULL fields (dropped later by
    # the required-value rule) instead of failing the job under ANSI mode
    cols = [F.try_element_at("a", F.lit(i + 1)).try_cast(typed.get(name, "double")).alias(name)
            for i, name in enumerate(KLINE_FIELDS) if name != "unused_field"]
    b = rows.select("market", *cols)
    date = ms_to_ntz("datetime", zone)
    b = b.select("*", date.alias("date"), *calendar_columns(date))
    return b.select(*BAR_COLUMNS), failed


# --- market list (S2, F1) ----------------------------------------------------

def market_list_replies(events: DataFrame) -> DataFrame:
    """One exchange-info reply per day listing the symbols traded that day."""
    day = floor_div(epoch_us("ts"), MS_PER_DAY * 1000) * F.lit(MS_PER_DAY)
    per_day = events.select(day.alias("server_time"), F.col("event_type").alias("symbol")).distinct()
    body = F.struct(F.col("server_time").alias("serverTime"),
                    F.collect_list(F.struct(F.col("symbol"), F.lit("TRADING").alias("status")))
                    .alias("symbols"))
    return per_day.groupBy("server_time").agg(F.to_json(body).alias("reply"))


def tag_market_list(replies: DataFrame) -> DataFrame:
    """(server_time, symbol, reason, raw): a row for each listed symbol, and one for each reply that lists none it can read."""
    r = replies.withColumn("_r", F.from_json("reply", MARKET_LIST_SCHEMA))
    r = tagged(r, F.col("_r.serverTime").isNotNull() & F.col("_r.symbols").isNotNull(), _why(F.col("reply"), {"serverTime": "bigint", "symbols": None}), "reply")
    each = r.select("reply", "reason", "raw", F.col("_r.serverTime").alias("server_time"), F.explode(_one_or_all("_r.symbols")).alias("s"))
    return (_tag_items(each, F.col("s.symbol").isNotNull(), "symbol missing")
            .select("server_time", F.col("s.symbol").alias("symbol"), "reason", "raw"))


def _one_or_all(items: str) -> Column:
    """The items of a reply; one null item for a rejected reply, none for an empty list."""
    return F.when(F.col("reason").isNull(), F.col(items)).otherwise(F.array(F.lit(None)))


def _tag_items(each: DataFrame, good: Column, why: str) -> DataFrame:
    """Items of accepted replies that lack what they need are rejected with the reply's text."""
    bad = F.col("reason").isNull() & ~F.coalesce(good, F.lit(False))
    return each.withColumns({"raw": F.when(bad, F.col("reply")).otherwise(F.col("raw")), "reason": F.when(bad, F.lit(why)).otherwise(F.col("reason"))})


def decode_market_list(replies: DataFrame) -> DataFrame:
    return split(tag_market_list(replies))[0]


def symbols_with_prefix(symbols: DataFrame, money: str, col: str = "symbol") -> DataFrame:
    return symbols.filter(F.col(col).startswith(money))


# --- stream kline messages (S7, C1, N1) --------------------------------------

def kline_messages(bars: DataFrame, interval: str = "1h") -> DataFrame:
    """One websocket-style kline message per bar (event time = bar close)."""
    k = F.struct(
        F.col("datetime").alias("t"), F.col("close_time").alias("T"), F.col("market").alias("s"),
        F.lit(interval).alias("i"), dec_text("open").alias("o"), dec_text("close").alias("c"),
        dec_text("high").alias("h"), dec_text("low").alias("l"), dec_text("volume").alias("v"),
        F.col("nbr_trades").alias("n"), F.lit(True).alias("x"), dec_text("qav").alias("q"),
        dec_text("taker_base_vol").alias("V"), dec_text("taker_quote_vol").alias("Q"))
    msg = F.struct(F.lit("kline").alias("e"), F.col("close_time").alias("E"),
                   F.col("market").alias("s"), k.alias("k"))
    return bars.select(F.to_json(msg).alias("value"))


def tag_kline_messages(messages: DataFrame, zone: str = "UTC", text_col: str = "value") -> DataFrame:
    """Message text → columns of the long ``market`` table, ``reason`` and ``raw``:
    one parse tells a row from a reject. ``k`` is read as a string map, so t/T,
    v/V, q/Q stay distinct under any case setting; values use ``try_cast`` so a
    dirty field becomes NULL instead of failing."""
    # PERMISSIVE parsing turns unreadable text into a struct of NULLs
    m = messages.select(F.col(text_col).alias("_text"), F.from_json(text_col, KLINE_MESSAGE_SCHEMA).alias("m"))
    m = tagged(m, F.col("m.E").isNotNull() & F.col("m.k").isNotNull(), _why(F.col("_text"), {"E": "bigint", "k": None}), "_text")
    k = F.col("m.k")

    def num(key, t="double"):
        return k.getItem(key).try_cast(t)
    out = m.select(
        F.col("m.E").alias("event_timestamp"), ms_to_ntz(F.col("m.E"), zone).alias("event_date"),
        num("o").alias("open"), num("h").alias("high"), num("l").alias("low"), num("c").alias("close"),
        num("v").alias("volume"), num("t", "bigint").alias("start_timestamp"),
        num("T", "bigint").alias("close_timestamp"), num("q").alias("qav"),
        num("n", "int").alias("nbr_trades"), num("V").alias("taker_base_vol"),
        num("Q").alias("taker_quote_vol"), F.col("m.s").alias("symbol"), "reason", "raw")
    return out.select(*[f.name for f in MARKET_TABLE_SCHEMA.fields], "reason", "raw")


def decode_kline_messages(messages: DataFrame, zone: str = "UTC", text_col: str = "value") -> DataFrame:
    """The rows of ``tag_kline_messages`` that could be decoded."""
    return split(tag_kline_messages(messages, zone, text_col))[0]


# --- price snapshots (S15, D5) -----------------------------------------------

def price_snapshot_records(events: DataFrame) -> DataFrame:
    rec = F.struct(F.col("event_type").alias("Currency"),
                   F.date_format("ts", "yyyy-MM-dd").alias("date"),
                   F.date_format("ts", "HH:mm:ss").alias("time"),
                   dec_text("value").alias("price"))
    return events.select("event_id", F.to_json(rec).alias("record"))


def decode_price_snapshots(records: DataFrame) -> DataFrame:
    r = records.select("event_id", F.from_json("record", PRICE_SNAPSHOT_SCHEMA).alias("r"))
    d, t = F.col("r.date"), F.col("r.time")

    def part(c, start, n, typ="int"):
        return F.substring(c, start, n).try_cast(typ)
    # zone-free and tolerant: a malformed date or time gives NULL, not a failed job
    ts = F.try_make_timestamp_ntz(part(d, 1, 4), part(d, 6, 2), part(d, 9, 2),
                                  part(t, 1, 2), part(t, 4, 2), part(t, 7, 2, "decimal(8,6)"))
    return r.select(
        "event_id", F.col("r.Currency").alias("currency"), d.alias("snapshot_date"),
        t.alias("snapshot_time"), F.col("r.price").try_cast("double").alias("price"),
        ts.alias("snapshot_ts"))


# --- account balances (S16, N4) ----------------------------------------------

def balance_replies(events: DataFrame) -> DataFrame:
    """One account reply per user: free balance per asset = the user's value sum."""
    per_asset = (events.groupBy("user_id", F.col("event_type").alias("asset"))
                 .agg(F.sum(F.col("value").cast(PRICE_DECIMAL)).alias("free")))
    bal = F.struct(F.col("asset"), F.col("free").cast("string").alias("free"),
                   F.lit("0.00000000").alias("locked"))
    return (per_asset.groupBy("user_id")
            .agg(F.to_json(F.struct(F.col("user_id").alias("account"),
                                    F.collect_list(bal).alias("balances"))).alias("reply")))


def tag_balances(replies: DataFrame) -> DataFrame:
    """(account, asset, free, locked, reason, raw) of every balance of every account reply."""
    r = replies.withColumn("_r", F.from_json("reply", BALANCE_REPLY_SCHEMA))
    r = tagged(r, F.col("_r.account").isNotNull() & F.col("_r.balances").isNotNull(), _why(F.col("reply"), {"account": "bigint", "balances": None}), "reply")
    each = r.select("reply", "reason", "raw", F.col("_r.account").alias("account"), F.explode(_one_or_all("_r.balances")).alias("b"))
    return _tag_items(each, F.col("b.asset").isNotNull(), "asset missing").select(
        "account", F.col("b.asset").alias("asset"), F.col("b.free").try_cast("double").alias("free"), F.col("b.locked").try_cast("double").alias("locked"), "reason", "raw")


def balances_for_assets(replies: DataFrame, assets: list[str]) -> DataFrame:
    return split(tag_balances(replies))[0].filter(F.col("asset").isin(assets))


def tag_trades(replies: DataFrame, zone: str = "UTC") -> DataFrame:
    """Account trade list replies (JSON arrays of trade objects) → one typed row
    per trade, or a reject; decimal strings become doubles, ``time`` also a timestamp."""
    r = replies.withColumn("_r", F.from_json("reply", TRADES_REPLY_SCHEMA))
    # an error object would parse as a list of one trade without fields
    r = tagged(r, F.col("_r").isNotNull() & F.startswith(F.ltrim("reply"), F.lit("[")),
               F.when(F.col("reply").isNull(), "no text").when(F.startswith(F.ltrim("reply"), F.lit("{")), "no list").otherwise("unreadable"), "reply")
    each = r.select("reply", "reason", "raw", F.explode(_one_or_all("_r")).alias("t"))
    t = _tag_items(each, F.col("t.id").isNotNull() & F.col("t.time").isNotNull(), "id or time missing")
    return t.select(
        F.col("t.symbol").alias("symbol"), F.col("t.id").alias("trade_id"),
        F.col("t.orderId").alias("order_id"),
        *[F.col(f"t.{c}").try_cast("double").alias(n) for c, n in
          [("price", "price"), ("qty", "qty"), ("quoteQty", "quote_qty"), ("commission", "commission")]],
        F.col("t.commissionAsset").alias("commission_asset"), F.col("t.time").alias("time"),
        ms_to_ntz(F.col("t.time"), zone).alias("trade_time"),
        F.col("t.isBuyer").alias("is_buyer"), F.col("t.isMaker").alias("is_maker"),
        F.col("t.isBestMatch").alias("is_best_match"), "reason", "raw")


def decode_trades(replies: DataFrame, zone: str = "UTC") -> DataFrame:
    return split(tag_trades(replies, zone))[0]
