"""DuckDB SQL stating each registered query independently of the Spark code.

The bar stand-in is restated as a CTE; trailing averages are plain SQL windows
over whole partitions and the matrices are written as joins, so an agreement
checks the chunked windows and the one-pass pivots against the textbook form.
"""

from __future__ import annotations

from tidemark.sources.bars import FEATURE_MARKETS, TAKER_MIN_QTY, TARGET_MARKET
from tidemark.schemas import FEATURE_COLUMNS

DEC = "DECIMAL(28,8)"


def bars_cte(width_ms: int = 3_600_000) -> str:
    return f"""
ticks AS (
  SELECT event_type AS market, epoch_us(ts) AS t_us, value AS price,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS qty
  FROM events),
bars0 AS (
  SELECT market, (t_us // {width_ms * 1000}) * {width_ms} AS datetime,
         arg_min(price, t_us) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, t_us) AS close,
         CAST(sum(CAST(price AS {DEC})) AS DOUBLE) AS volume,
         CAST(sum(CAST(price AS {DEC}) * qty) AS DOUBLE) AS qav,
         count(*) AS nbr_trades,
         CAST(sum(CASE WHEN qty >= {TAKER_MIN_QTY} THEN CAST(price AS {DEC}) END) AS DOUBLE) AS taker_base_vol,
         CAST(sum(CASE WHEN qty >= {TAKER_MIN_QTY} THEN CAST(price AS {DEC}) * qty END) AS DOUBLE) AS taker_quote_vol
  FROM ticks GROUP BY 1, 2),
bars AS (
  SELECT market, datetime, open, high, low, close, volume, datetime + {width_ms - 1} AS close_time,
         qav, nbr_trades, taker_base_vol, taker_quote_vol,
         epoch_ms(datetime) AS date,
         CAST(year(epoch_ms(datetime)) AS INTEGER) AS year,
         CAST(month(epoch_ms(datetime)) AS INTEGER) AS month,
         CAST(day(epoch_ms(datetime)) AS INTEGER) AS day,
         CAST(isodow(epoch_ms(datetime)) AS INTEGER) AS day_of_week
  FROM bars0)"""


def with_bars(body: str, width_ms: int = 3_600_000, extra: str = "") -> str:
    ctes = bars_cte(width_ms) + ("," + extra if extra else "")
    return f"WITH {ctes}\n{body}"


def exact_avg(col: str, window: str) -> str:
    return f"CAST(sum(CAST({col} AS {DEC})) OVER {window} AS DOUBLE) / count({col}) OVER {window}"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


FEATS_IN = ", ".join(_q(m) for m in FEATURE_MARKETS)
ALL_IN = ", ".join(_q(m) for m in [TARGET_MARKET] + FEATURE_MARKETS)


def rolling_rows_cte(rows: int, out: str, markets_in: str = FEATS_IN) -> str:
    w = f"(PARTITION BY market ORDER BY datetime ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"""
rolled AS (
  SELECT *, {exact_avg('close', w)} AS {out}
  FROM bars WHERE market IN ({markets_in}))"""


def matrix_join_sql(rows: int = 7) -> str:
    t = TARGET_MARKET
    sel = [f"tg.datetime", f"tg.close AS {t}_close", "tg.day", "tg.month", "tg.year", "tg.day_of_week"]
    joins = []
    for i, m in enumerate(FEATURE_MARKETS):
        a = f"f{i}"
        for c in FEATURE_COLUMNS:
            expr = f"CAST({a}.{c} AS DOUBLE)" if c == "nbr_trades" else f"{a}.{c}"
            sel.append(f"{expr} AS {m}_{c}")
        joins.append(f"JOIN (SELECT * FROM rolled WHERE market = {_q(m)}) {a} ON {a}.datetime = tg.datetime")
    body = (f"SELECT {', '.join(sel)}\nFROM (SELECT * FROM bars WHERE market = {_q(t)}) tg\n"
            + "\n".join(joins))
    return with_bars(body, extra=rolling_rows_cte(rows, "rolling_avg_7d"))


def close_time_matrix_sql(rows: int = 8) -> str:
    t = TARGET_MARKET
    sel = ["tg.close_time"]
    joins = []
    for i, m in enumerate(FEATURE_MARKETS):
        a = f"f{i}"
        sel.append(f"{a}.average AS {m}_average")
        joins.append(f"JOIN (SELECT * FROM rolled WHERE market = {_q(m)}) {a} ON {a}.close_time = tg.close_time")
    sel.append(f"tg.close AS {t}_close_price")
    body = (f"SELECT DISTINCT {', '.join(sel)}\nFROM (SELECT * FROM bars WHERE market = {_q(t)}) tg\n"
            + "\n".join(joins) + "\nORDER BY tg.close_time")
    return with_bars(body, extra=rolling_rows_cte(rows, "average"))


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    bar_cols = ("market, datetime, open, high, low, close, volume, close_time, qav, nbr_trades, "
                "taker_base_vol, taker_quote_vol, date, year, month, day, day_of_week")
    q["bar_scan"] = with_bars(f"SELECT {bar_cols} FROM bars")
    q["market_feature_matrix"] = matrix_join_sql(7)
    q["market_feature_matrix_joins"] = matrix_join_sql(7)
    q["close_time_matrix"] = close_time_matrix_sql(8)
    w7 = "(PARTITION BY market ORDER BY datetime ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    w8 = "(PARTITION BY market ORDER BY datetime ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)"
    wr = "(PARTITION BY market ORDER BY datetime RANGE BETWEEN 604800000 PRECEDING AND CURRENT ROW)"
    q["trailing_avg_rows7"] = with_bars(
        f"SELECT market, datetime, close_time, close, {exact_avg('close', w7)} AS rolling_avg_7d "
        f"FROM bars WHERE market IN ({FEATS_IN})")
    q["trailing_avg_rows8"] = with_bars(
        f"SELECT market, datetime, close_time, close, {exact_avg('close', w8)} AS average "
        f"FROM bars WHERE market IN ({FEATS_IN})")
    q["trailing_avg_range7d"] = with_bars(
        f"SELECT market, datetime, close, {exact_avg('close', wr)} AS rolling_avg_range7d FROM bars")
    wt = "(PARTITION BY market ORDER BY t_ms RANGE BETWEEN 604800000 PRECEDING AND CURRENT ROW)"
    q["tick_avg_range7d"] = ("WITH t AS (SELECT event_id, event_type AS market, epoch_us(ts) // 1000 AS t_ms, value FROM events) "
                             f"SELECT event_id, market, t_ms, value, {exact_avg('value', wt)} AS avg_range7d FROM t")
    q["point_avg"] = (
        "SELECT event_type AS market, (epoch_us(ts) // 60000000) * 60000 AS event_timestamp, "
        f"CAST(sum(CAST(value AS {DEC})) AS DOUBLE) / count(value) AS avg_close "
        "FROM events GROUP BY 1, 2")
    q.update(_explore_queries())
    q.update(_reply_queries())
    q.update(_serving_queries(q))
    q.update(_ml_queries(q))
    q.update(_stream_queries(q))
    return q


def _explore_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    bar_cols = ("market, datetime, open, high, low, close, volume, close_time, qav, nbr_trades, "
                "taker_base_vol, taker_quote_vol, date, year, month, day, day_of_week")
    q["market_slice"] = with_bars(f"SELECT {bar_cols} FROM bars WHERE market = {_q(TARGET_MARKET)}")
    q["distinct_markets"] = with_bars("SELECT DISTINCT market FROM bars")
    q["bars_per_market"] = with_bars("SELECT market, count(*) AS n_bars FROM bars GROUP BY market")
    q["count_by_key"] = with_bars("SELECT datetime, count(*) AS n_rows FROM bars GROUP BY datetime")
    q["first_bars"] = with_bars(
        "SELECT market, datetime, open, close, volume FROM bars ORDER BY datetime, market LIMIT 20")
    q["latest_bars"] = with_bars(
        "SELECT market, datetime, close, nbr_trades FROM ("
        " SELECT *, row_number() OVER (PARTITION BY market ORDER BY datetime DESC) AS rn FROM bars)"
        " WHERE rn <= 24")
    q["first_close_time"] = with_bars(
        "SELECT market, min(datetime) AS first_datetime, arg_min(close_time, datetime) AS first_close_time "
        "FROM bars GROUP BY market")
    q["union_bars"] = with_bars(f"SELECT {bar_cols} FROM bars")
    hour5 = "((datetime // 3600000) % 24) = 5"
    fixed = bar_cols.replace("close,", f"CASE WHEN {hour5} THEN close + 1 ELSE close END AS close,", 1).replace(
        "nbr_trades,", f"CASE WHEN {hour5} THEN nbr_trades + 1 ELSE nbr_trades END AS nbr_trades,", 1)
    q["clean_bars"] = with_bars(f"SELECT {fixed} FROM bars WHERE close <> 0")
    q["append_bars"] = with_bars(f"SELECT {bar_cols} FROM bars")
    cols = [c.strip() for c in bar_cols.split(",")]
    parts = [f"SELECT {_q(c)} AS column_name, CAST({i} AS INTEGER) AS position "
             f"FROM (SELECT count(*) FILTER (WHERE {c} IS NULL) AS n FROM bars) WHERE n = 0"
             for i, c in enumerate(cols)]
    q["drop_null_columns"] = with_bars("\nUNION ALL\n".join(parts))
    q["calendar_features"] = (
        "SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, "
        "CAST(day(ts) AS INTEGER) AS day, CAST(isodow(ts) AS INTEGER) AS day_of_week, "
        "CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week0 FROM events")
    q["epoch_roundtrip"] = (
        "SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms, epoch_ms(epoch_us(ts) // 1000) AS ts_ms FROM events")
    summ = []
    for c in ["close", "volume", "nbr_trades"]:
        summ.append(
            f"SELECT market, {_q(c)} AS column_name, count({c}) AS count, "
            f"CAST(sum(CAST({c} AS {DEC})) AS DOUBLE) / count({c}) AS mean, "
            f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, "
            f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM bars GROUP BY market")
    q["feature_summary"] = q["feature_summary_scan"] = with_bars("\nUNION ALL\n".join(summ))
    # Driver rows left-joined with the other markets, absent values 0
    drv, others = FEATURE_MARKETS[0], FEATURE_MARKETS[1:]
    wr = "(PARTITION BY market ORDER BY datetime RANGE BETWEEN 604800000 PRECEDING AND CURRENT ROW)"
    rolled = (f"rolled AS (SELECT *, {exact_avg('close', wr)} AS rolling_avg_7d "
              f"FROM bars WHERE market IN ({FEATS_IN}))")
    sel = ["d.datetime", "CAST(day(epoch_ms(d.datetime)) AS INTEGER) AS day",
           "CAST(month(epoch_ms(d.datetime)) AS INTEGER) AS month",
           "CAST(year(epoch_ms(d.datetime)) AS INTEGER) AS year",
           "CAST(isodow(epoch_ms(d.datetime)) - 1 AS INTEGER) AS day_of_week"]
    for c in FEATURE_COLUMNS:
        t = "INTEGER" if c == "nbr_trades" else "DOUBLE"
        sel.append(f"CAST(d.{c} AS {t}) AS {drv}_{c}")
    joins = []
    for i, m in enumerate(others):
        a = f"o{i}"
        for c in FEATURE_COLUMNS:
            t = "INTEGER" if c == "nbr_trades" else "DOUBLE"
            sel.append(f"CAST(COALESCE({a}.{c}, 0) AS {t}) AS {m}_{c}")
        joins.append(f"LEFT JOIN (SELECT * FROM rolled WHERE market = {_q(m)}) {a} ON {a}.datetime = d.datetime")
    q["driver_left_enrich"] = with_bars(
        f"SELECT {', '.join(sel)} FROM (SELECT * FROM rolled WHERE market = {_q(drv)}) d\n" + "\n".join(joins),
        extra=rolled)
    q["driver_semi"] = with_bars(
        f"SELECT market, datetime, close FROM bars WHERE market IN ({FEATS_IN}) AND market <> {_q(drv)} "
        f"AND datetime IN (SELECT datetime FROM bars WHERE market = {_q(drv)})")
    return q


def _reply_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    bar_cols = ("market, datetime, open, high, low, close, volume, close_time, qav, nbr_trades, "
                "taker_base_vol, taker_quote_vol, date, year, month, day, day_of_week")
    q["kline_array_decode"] = with_bars(f"SELECT {bar_cols} FROM bars")
    q["paged_replies"] = q["paged_stream"] = q["kline_array_decode"]
    q["paged_week"] = with_bars(f"SELECT {bar_cols} FROM bars WHERE datetime >= (SELECT max(datetime) FROM bars) - 604800000")
    q["tolerant_decode"] = with_bars(f"SELECT {bar_cols} FROM bars WHERE market <> 'error'")
    day = "(epoch_us(ts) // 86400000000) * 86400000"
    q["symbol_list"] = f"SELECT DISTINCT {day} AS server_time, event_type AS symbol FROM events"
    q["symbol_prefix_filter"] = (f"SELECT DISTINCT {day} AS server_time, event_type AS symbol FROM events "
                                 "WHERE starts_with(event_type, 'p')")
    q["kline_message_decode"] = with_bars(
        "SELECT close_time AS event_timestamp, epoch_ms(close_time) AS event_date, open, high, low, close, "
        "volume, datetime AS start_timestamp, close_time AS close_timestamp, qav, "
        "CAST(nbr_trades AS INTEGER) AS nbr_trades, taker_base_vol, taker_quote_vol, market AS symbol FROM bars")
    what = ("CASE (datetime // 3600000) % 24 WHEN 1 THEN 'unreadable' WHEN 2 THEN 'E of wrong type' WHEN 3 THEN 'E missing' "
            "WHEN 4 THEN 'k missing' WHEN 5 THEN 'field of wrong type' ELSE 'decoded' END")
    q["message_rejects"] = with_bars(f"SELECT {what} AS outcome, count(*) AS n, CASE WHEN {what} = 'decoded' THEN 0 ELSE count(*) END AS n_raw FROM bars GROUP BY 1")
    q["stream_rejects"] = with_bars(f"SELECT {what} AS outcome, count(*) AS n FROM bars GROUP BY 1")
    q["json_field"] = "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"
    q["price_snapshot"] = (
        "SELECT event_id, event_type AS currency, strftime(ts, '%Y-%m-%d') AS snapshot_date, "
        "strftime(ts, '%H:%M:%S') AS snapshot_time, value AS price, "
        "date_trunc('second', ts) AS snapshot_ts FROM events")
    q["nested_balance_filter"] = (
        f"SELECT user_id AS account, event_type AS asset, CAST(sum(CAST(value AS {DEC})) AS DOUBLE) AS free, "
        "CAST(0 AS DOUBLE) AS locked FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY 1, 2")
    period = ("CAST(floor(CAST((end_ms - start_ms) // 86400000 AS DOUBLE) * 86400000.0 * 60000000.0 "
              "/ CAST(end_ms - start_ms AS DOUBLE)) AS BIGINT)")
    q["chunk_plan"] = f"""
WITH spans AS (
  SELECT event_type AS symbol, (min(epoch_us(ts)) // 86400000000) * 86400000 AS start_ms,
         (max(epoch_us(ts)) // 86400000000 + 1) * 86400000 AS end_ms
  FROM events GROUP BY 1),
p AS (SELECT *, CASE WHEN {period} > 0 THEN {period} ELSE end_ms - start_ms END AS period FROM spans),
c AS (SELECT symbol, start_ms, end_ms, period,
             unnest(range(0, CAST(ceil((end_ms - start_ms) / period) AS BIGINT))) AS chunk
      FROM p WHERE period > 0)
SELECT symbol, CAST(chunk AS INTEGER) AS chunk, start_ms + chunk * period AS window_start_ms,
       least(start_ms + chunk * period + period, end_ms) AS window_end_ms,
       CAST(start_ms + chunk * period AS VARCHAR) AS startTime,
       CAST(least(start_ms + chunk * period + period, end_ms) AS VARCHAR) AS endTime
FROM c"""
    q["trade_list_decode"] = ("SELECT event_id AS trade_id, event_type AS symbol, user_id AS order_id, round(CAST(printf('%.8f', value) AS DOUBLE), 6) AS price, "
                              "CAST(2 AS DOUBLE) AS qty, CAST(NULL AS DOUBLE) AS quote_qty, epoch_us(ts) // 1000 AS time, event_id % 2 = 0 AS is_buyer, "
                              "false AS is_maker FROM events")
    q["json_reader"] = with_bars("SELECT market, datetime, open, close, nbr_trades FROM bars")
    q["dropped_columns"] = with_bars("SELECT market, datetime, close, nbr_trades FROM bars")
    hourly = period.replace("60000000.0", "3600000000.0")
    q["chunk_plan_1h"] = f"""
WITH spans AS (
  SELECT event_type AS symbol, (min(epoch_us(ts)) // 86400000000) * 86400000 AS start_ms,
         (max(epoch_us(ts)) // 86400000000 + 1) * 86400000 AS end_ms
  FROM events GROUP BY 1),
p AS (SELECT *, CASE WHEN {hourly} > 0 THEN {hourly} ELSE end_ms - start_ms END AS period FROM spans),
c AS (SELECT symbol, start_ms, end_ms, period,
             unnest(range(0, CAST(ceil((end_ms - start_ms) / (period + 86400000)) AS BIGINT))) AS chunk
      FROM p WHERE period > 0)
SELECT symbol, CAST(chunk AS INTEGER) AS chunk, start_ms + chunk * (period + 86400000) AS window_start_ms,
       least(start_ms + chunk * (period + 86400000) + period, end_ms) AS window_end_ms,
       CAST(start_ms + chunk * (period + 86400000) AS VARCHAR) AS startTime,
       CAST(least(start_ms + chunk * (period + 86400000) + period, end_ms) AS VARCHAR) AS endTime
FROM c"""
    q["reply_rejects"] = with_bars("SELECT 'error' AS symbol, count(DISTINCT datetime // 3600000000) AS n_rejected FROM bars WHERE market = 'error'")
    return q


def _serving_queries(base: dict[str, str]) -> dict[str, str]:
    q: dict[str, str] = {}
    mk = FEATURE_MARKETS
    avgs = []
    for m in mk:
        for c in FEATURE_COLUMNS:
            x = f"{m}_{c}"
            e = f"CASE WHEN {x} <> 0 THEN {x} END" if c == "close" else x
            avgs.append(f"CAST(sum(CAST({e} AS {DEC})) AS DOUBLE) / count({e}) AS {x}")
    any_close = " OR ".join(f"{m}_close <> 0" for m in mk)
    q["serving_window_avg"] = f"""
WITH wide AS ({base["driver_left_enrich"]}),
as_of_day AS (SELECT CAST(max(ts) AS DATE) + 1 AS end_day FROM events),
b AS (SELECT end_day, epoch_ms(CAST(end_day - 6 AS TIMESTAMP)) AS lo, epoch_ms(CAST(end_day AS TIMESTAMP)) AS hi FROM as_of_day)
SELECT CAST(day(any_value(end_day)) AS INTEGER) AS day, CAST(month(any_value(end_day)) AS INTEGER) AS month,
       CAST(year(any_value(end_day)) AS INTEGER) AS year, CAST(isodow(any_value(end_day)) - 1 AS INTEGER) AS day_of_week,
       {", ".join(avgs)}
FROM b LEFT JOIN wide ON wide.datetime BETWEEN b.lo AND b.hi AND ({any_close})"""
    pred = " + ".join(f"{m}_rolling_avg_7d" for m in mk)
    q["buy_signal"] = f"""
WITH m AS ({base["market_feature_matrix"]}), s AS (SELECT datetime, ({pred}) / {float(len(mk))} AS prediction FROM m)
SELECT datetime, prediction, (prediction < 50.0 AND prediction <> 0) AS buy FROM s"""
    t = f"{TARGET_MARKET}_close"
    q["limit_price"] = f"""
WITH m AS ({base["market_feature_matrix"]})
SELECT datetime, {t}, round_even({t} * 1.01, 2) AS order_price FROM m"""
    return q


def _ml_queries(base: dict[str, str]) -> dict[str, str]:
    q: dict[str, str] = {}
    bucket = "CAST((('0x' || substr(md5(CAST(datetime AS VARCHAR)), 1, 8))::BIGINT) % 100 AS INTEGER)"
    split = f"SELECT *, {bucket} AS split_bucket, {bucket} < 75 AS is_train FROM m"
    mtx = base["market_feature_matrix"]
    q["hash_split"] = f"WITH m AS ({mtx}), s AS ({split}) SELECT datetime, split_bucket, is_train FROM s"
    cont = [f"{m}_{c}" for m in FEATURE_MARKETS for c in FEATURE_COLUMNS]
    stats = ", ".join(f"CAST(sum(CAST({c} AS {DEC})) AS DOUBLE) / count({c}) AS m_{c}, "
                      f"stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in cont)
    zs = ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6) AS {c}" for c in cont)
    q["scaled_features"] = (f"WITH m AS ({mtx}), s AS ({split}), st AS (SELECT {stats} FROM s WHERE is_train) "
                            f"SELECT datetime, {zs} FROM s, st")
    parts = " UNION ALL ".join(f"SELECT datetime, '{c}' AS c, CAST({c} AS INTEGER) AS v FROM t" for c in ("day", "month", "year", "day_of_week"))
    q["one_hot_calendar"] = (f"WITH m AS ({mtx}), s AS ({split}), t AS (SELECT * FROM s WHERE is_train), l AS ({parts}), "
                             "k AS (SELECT DISTINCT c, v, min(v) OVER (PARTITION BY c) AS least FROM l) "
                             "SELECT l.datetime, l.c || '_' || k.v AS feature, CAST(l.v = k.v AS INTEGER) AS hot "
                             "FROM l JOIN k ON l.c = k.c WHERE k.v > k.least")
    test = f"WITH m AS ({mtx}), s AS ({split}) SELECT datetime, {TARGET_MARKET}_close AS label, true AS {{}} FROM s WHERE NOT is_train"
    for name, flag in [("train_linear", "normal_equations"), ("train_decision_tree", "within_train_labels"), ("train_random_forest", "within_train_labels"),
                       ("train_gbt", "beats_the_mean"), ("model_roundtrip_score", "loaded_equals_saved")]:
        q[name] = test.format(flag)
    q.update(_small_model_sql(mtx, split, base["driver_left_enrich"]))
    q["best_model"] = "SELECT CAST(4 AS BIGINT) AS candidates, true AS best_has_least_rmse, CAST(1 AS BIGINT) AS chosen"
    q["close_time_linear"] = _least_squares_sql(base["close_time_matrix"])
    close = [f"{m}_close" for m in FEATURE_MARKETS]
    q["score_requests"] = f"""
WITH m AS ({mtx}), s AS ({split}), t AS (SELECT day, month, year, day_of_week FROM s WHERE is_train),
w AS ({base["driver_left_enrich"]}),
e AS (SELECT *, unnest(range(CAST(ceil(datetime / 86400000.0) AS BIGINT), datetime // 86400000 + 7)) AS end_day
      FROM w WHERE {" OR ".join(f"{c} <> 0" for c in close)}),
g AS (SELECT end_day, {" AND ".join(f"count(nullif({c}, 0)) > 0" for c in close)} AS whole,
             DATE '1970-01-01' + CAST(end_day AS INTEGER) AS d FROM e GROUP BY end_day),
a AS (SELECT end_day, whole AND day(d) IN (SELECT day FROM t) AND month(d) IN (SELECT month FROM t) AND year(d) IN (SELECT year FROM t)
             AND isodow(d) IN (SELECT day_of_week FROM t) AS accepted FROM g)
SELECT end_day * 86400000 AS request_day_ms, accepted, accepted AS answered FROM a"""
    r7 = base["trailing_avg_rows7"]
    q["rmse_per_market"] = (f"WITH r AS ({r7}) SELECT market, count(*) AS n, "
                            "round(sqrt(avg((close - rolling_avg_7d) * (close - rolling_avg_7d))), 6) AS rmse "
                            "FROM r GROUP BY market")
    q["r2_per_market"] = (f"WITH r AS ({r7}), g AS (SELECT market, count(*) AS n, "
                          "sum((close - rolling_avg_7d) * (close - rolling_avg_7d)) AS ss_res, "
                          "var_pop(close) AS var FROM r GROUP BY market) "
                          "SELECT market, n, round(1.0 - ss_res / (var * n), 6) AS r2 FROM g")
    return q


def _split_sql(src: str, name: str, features: list[str]) -> str:
    """CTE ``name``: the best exact split of each node of ``src`` (node, y, features)."""
    pairs = " UNION ALL ".join(f"SELECT node, {k} AS fi, '{f}' AS feature, CAST({f} AS DOUBLE) AS v, CAST(y AS {DEC}) AS y FROM {src}" for k, f in enumerate(features))
    return f"""{name}_v AS (SELECT node, fi, feature, v, count(*) AS n, sum(y) AS s FROM ({pairs}) GROUP BY ALL),
{name}_r AS (SELECT node, fi, feature, v, lead(v) OVER o AS nv, sum(n) OVER o AS nl, CAST(sum(s) OVER o AS DOUBLE) AS sl, sum(n) OVER w AS n, CAST(sum(s) OVER w AS DOUBLE) AS s
  FROM {name}_v WINDOW o AS (PARTITION BY node, fi ORDER BY v), w AS (PARTITION BY node, fi)),
{name}_g AS (SELECT *, (v + nv) / 2 AS threshold, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM {name}_r WHERE nv IS NOT NULL),
{name} AS (SELECT node, feature, threshold, CAST(nl AS BIGINT) AS n_left, CAST(n - nl AS BIGINT) AS n_right, sl / nl AS mean_left, (s - sl) / (n - nl) AS mean_right, gain
  FROM {name}_g WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, fi, threshold) = 1)"""


def _below(src: str, splits: str, features: list[str], children: tuple[str, str]) -> str:
    """Rows of ``src`` at the child they fall to, rows of nodes without a split left out."""
    value = "CASE b.feature " + " ".join(f"WHEN '{f}' THEN CAST(a.{f} AS DOUBLE)" for f in features) + " END"
    left, right = (c.format("b.node") for c in children)
    return f"SELECT a.* EXCLUDE (node), CASE WHEN {value} > b.threshold THEN {right} ELSE {left} END AS node FROM {src} a JOIN {splits} b ON a.node = b.node"


def _bins_sql(src: str, name: str, features: list[str], penalty: float, least_gain: float) -> str:
    """CTE ``name``: the best second-order split of each node of ``src`` (node, y, bin of each feature as b0, b1, …); start in ``base``."""
    pairs = " UNION ALL ".join(f"SELECT node, {k} AS fi, b{k} AS bin, y - m AS e FROM {src}, base" for k in range(len(features)))
    return f"""{name}_v AS (SELECT node, fi, bin, count(*) AS n, -sum(e) AS g FROM ({pairs}) GROUP BY ALL),
{name}_r AS (SELECT node, fi, bin, sum(n) OVER o AS hl, sum(g) OVER o AS gl, sum(n) OVER w AS h, sum(g) OVER w AS g FROM {name}_v WINDOW o AS (PARTITION BY node, fi ORDER BY bin), w AS (PARTITION BY node, fi)),
{name} AS (SELECT *, gl * gl / (hl + {penalty}) + (g - gl) * (g - gl) / (h - hl + {penalty}) - g * g / (h + {penalty}) AS gain FROM {name}_r WHERE hl < h
  QUALIFY gain > {least_gain} AND row_number() OVER (PARTITION BY node ORDER BY round(gain, 6) DESC, fi, bin) = 1)"""


def _small_model_sql(mtx: str, split: str, wide: str) -> dict[str, str]:
    """Tree of two levels, first boosting tree, linear model: fitted in SQL."""
    cal, roll = ["day", "month", "day_of_week"], [f"{m}_rolling_avg_7d" for m in FEATURE_MARKETS]
    label = f"{TARGET_MARKET}_close"
    base = f"m AS ({mtx}), s AS ({split}), d AS (SELECT datetime, {label} AS y, {', '.join(cal + roll)}, is_train FROM s)"
    heap = ("2 * {}", "2 * {} + 1")
    # every row walks down, splits come from the train rows
    tree = (f"{base}, t1 AS (SELECT *, 1 AS node FROM d), f1 AS (SELECT * FROM t1 WHERE is_train), {_split_sql('f1', 's1', cal)}, "
            f"t2 AS ({_below('t1', 's1', cal, heap)}), f2 AS (SELECT * FROM t2 WHERE is_train), {_split_sql('f2', 's2', cal)}, "
            "sp AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2)")
    out = {"tree_splits": f"WITH {tree} SELECT node, feature, threshold, n_left, n_right, round(gain, 4) AS gain, true AS fitted FROM sp"}
    last = f"t3 AS ({_below('t2', 's2', cal, heap)} UNION ALL SELECT * EXCLUDE (node), node FROM t2 WHERE node NOT IN (SELECT node FROM s2))"
    leaves = ("lv AS (SELECT 2 * node AS leaf, mean_left AS v FROM sp UNION ALL SELECT 2 * node + 1, mean_right FROM sp)")
    tree_scores = f"{tree}, {last}, {leaves}, tree_out AS (SELECT 'tree' AS model, datetime AS key, y AS label, v AS prediction FROM t3 JOIN lv ON lv.leaf = t3.node WHERE NOT is_train)"
    # boosting: bins end at quantiles of the train rows
    cuts = ", ".join(f"list_sort(list_distinct([{', '.join(f'quantile_disc({f}, {k / 16!r})' for k in range(1, 16))}])) AS q{j}, max({f}) AS x{j}" for j, f in enumerate(roll))
    kept = ", ".join(f"list_filter(q{j}, lambda q: q < x{j}) AS c{j}" for j in range(len(roll)))
    bins = ", ".join(f"len(list_filter(c{j}, lambda q: q < {f})) AS b{j}" for j, f in enumerate(roll))
    down = ("2 * {} + 1", "2 * {} + 2")
    step = lambda src, best: (f"SELECT a.* EXCLUDE (node), CASE WHEN CASE b.fi {' '.join(f'WHEN {j} THEN a.b{j}' for j in range(len(roll)))} END > b.bin "  # noqa: E731
                              f"THEN {down[1].format('b.node')} ELSE {down[0].format('b.node')} END AS node FROM {src} a JOIN {best} b ON a.node = b.node")
    boost = (f"{base}, base AS (SELECT avg(y) AS m FROM d WHERE is_train), q AS (SELECT {cuts} FROM d WHERE is_train), c AS (SELECT {kept} FROM q), "
             f"u1 AS (SELECT d.*, {bins}, 0 AS node FROM d, c), e1 AS (SELECT * FROM u1 WHERE is_train), {_bins_sql('e1', 'g1', roll, 1.0, 1e-9)}, "
             f"u2 AS ({step('u1', 'g1')}), e2 AS (SELECT * FROM u2 WHERE is_train), {_bins_sql('e2', 'g2', roll, 1.0, 1e-9)}, "
             "bs AS (SELECT * FROM g1 UNION ALL SELECT * FROM g2), "
             "bw AS (SELECT 0 AS node, -0.3 * sum(m - y) / (count(*) + 1.0) AS weight FROM e1, base UNION ALL "
             "SELECT 2 * node + 1, -0.3 * gl / (hl + 1.0) FROM bs UNION ALL SELECT 2 * node + 2, -0.3 * (g - gl) / (h - hl + 1.0) FROM bs)")
    name = "CASE fi " + " ".join(f"WHEN {j} THEN '{f}'" for j, f in enumerate(roll)) + " END"
    cut = "CASE fi " + " ".join(f"WHEN {j} THEN c{j}[bin + 1]" for j in range(len(roll))) + " END"
    out["boosting_first_tree"] = f"WITH {boost} SELECT CAST(bw.node AS INTEGER) AS node, {name} AS feature, round({cut}, 6) AS cut, round(weight, 6) AS weight FROM bw LEFT JOIN bs ON bs.node = bw.node, c"
    boost_scores = (f"{boost}, u3 AS ({step('u2', 'g2')} UNION ALL SELECT * FROM u2 WHERE node NOT IN (SELECT node FROM g2)), "
                    "boost_out AS (SELECT 'boosting' AS model, datetime AS key, y AS label, m + weight AS prediction FROM u3 JOIN bw ON bw.node = u3.node, base WHERE NOT is_train)")
    # linear: least squares by taking the features out of each other
    xs = ", ".join(f"{f} AS x{k}" for k, f in enumerate(roll, 1))
    linear = f"{base}, d_ AS (SELECT datetime AS close_time, y, {xs}, is_train FROM d), {_orthogonal_sql('d_', len(roll))}"
    linear_scores = f"WITH {linear} SELECT 'linear' AS model, close_time AS key, y AS label, y - e AS prediction FROM d{len(roll)} WHERE NOT is_train"
    # requests go through the same steps as further rows: their key is below 0, their label 0
    means = ", ".join(f"CAST(sum(CAST({f} AS {DEC})) AS DOUBLE) / count({f}) AS x{k}" for k, f in enumerate(roll, 1))
    traded = " OR ".join(f"{m}_close <> 0" for m in FEATURE_MARKETS)
    requests = (f"w AS ({wide}), ex AS (SELECT *, unnest(range(CAST(ceil(datetime / 86400000.0) AS BIGINT), datetime // 86400000 + 7)) AS end_day FROM w WHERE {traded}), "
                f"rq AS (SELECT -end_day - 1 AS close_time, 0.0::DOUBLE AS y, {means}, false AS is_train FROM ex GROUP BY end_day)")
    out["request_predictions"] = (f"WITH {base}, {requests}, d_ AS (SELECT datetime AS close_time, y, {xs}, is_train FROM d UNION ALL SELECT * FROM rq), {_orthogonal_sql('d_', len(roll))} "
                                  f"SELECT (-close_time - 1) * 86400000 AS request_day_ms, round(-e, 4) AS prediction, (-e < 50.0 AND e <> 0) AS buy FROM d{len(roll)} WHERE close_time < 0")
    union = (f"SELECT * FROM ({linear_scores}) UNION ALL SELECT * FROM (WITH {tree_scores} SELECT model, key, label, prediction FROM tree_out) "
             f"UNION ALL SELECT * FROM (WITH {boost_scores} SELECT model, key, label, prediction FROM boost_out)")
    out["candidate_scores"] = f"SELECT model, key, label, round(prediction, 4) AS prediction FROM ({union})"
    out["best_candidate"] = (f"WITH r AS (SELECT model, sqrt(avg((label - prediction) * (label - prediction))) AS rmse FROM ({union}) GROUP BY model) "
                             "SELECT model, round(rmse, 4) AS rmse, rmse = min(rmse) OVER () AS is_best FROM r")
    return out


def _least_squares_sql(matrix: str) -> str:
    """Least squares by orthogonalising the features one after the other over the train rows."""
    order = [FEATURE_MARKETS[0], FEATURE_MARKETS[3], FEATURE_MARKETS[1], FEATURE_MARKETS[2]]
    xs = ", ".join(f"{m}_average AS x{k}" for k, m in enumerate(order, 1))
    bucket = "CAST((('0x' || substr(md5(CAST(close_time AS VARCHAR)), 1, 8))::BIGINT) % 100 AS INTEGER)"
    data = f"WITH m AS ({matrix}), d AS (SELECT close_time, {TARGET_MARKET}_close_price AS y, {xs}, {bucket} < 80 AS is_train FROM m), "
    return data + _orthogonal_sql("d", 4) + " SELECT close_time, y AS label, round(y - e, 4) AS prediction FROM d4 WHERE NOT is_train"


def _orthogonal_sql(src: str, n: int) -> str:
    """CTEs up to ``d<n>``: what is left of y (e) when the features x1 … xn of ``src`` are taken out one after the other."""
    sql = (f"c0 AS (SELECT avg(y) AS my, " + ", ".join(f"avg(x{k}) AS m{k}" for k in range(1, n + 1)) + f" FROM {src} WHERE is_train), "
           "d0 AS (SELECT close_time, y, is_train, y - my AS e, my, " + ", ".join(f"x{k} - m{k} AS x{k}" for k in range(1, n + 1)) + f" FROM {src}, c0)")
    for k in range(1, n + 1):      # take x_k out of y and of the features after it
        rest = range(k + 1, n + 1)
        slopes = [f"sum(e * x{k}) / sum(x{k} * x{k}) AS b"] + [f"sum(x{j} * x{k}) / sum(x{k} * x{k}) AS b{j}" for j in rest]
        sql += (f", c{k} AS (SELECT {', '.join(slopes)} FROM d{k - 1} WHERE is_train), d{k} AS (SELECT close_time, y, is_train, my, "
                f"e - b * x{k} AS e" + "".join(f", x{j} - b{j} * x{k} AS x{j}" for j in rest) + f" FROM d{k - 1}, c{k})")
    return sql


def _stream_queries(base: dict[str, str]) -> dict[str, str]:
    q: dict[str, str] = {"stream_append_market": base["kline_message_decode"]}
    wr = "(PARTITION BY market ORDER BY close_time RANGE BETWEEN 604800000 PRECEDING AND CURRENT ROW)"
    q["stream_trailing_avg"] = with_bars(
        f"SELECT market AS symbol, close_time AS event_timestamp, close, {exact_avg('close', wr)} AS rolling_avg_7d "
        "FROM bars")
    drv, others = FEATURE_MARKETS[0], FEATURE_MARKETS[1:]
    rolled = (f"rolled AS (SELECT *, {exact_avg('close', wr)} AS rolling_avg_7d "
              f"FROM bars WHERE market IN ({FEATS_IN}))")
    sel = ["d.close_time AS start_timestamp", "CAST(day(epoch_ms(d.close_time)) AS INTEGER) AS day",
           "CAST(month(epoch_ms(d.close_time)) AS INTEGER) AS month",
           "CAST(year(epoch_ms(d.close_time)) AS INTEGER) AS year",
           "CAST(isodow(epoch_ms(d.close_time)) - 1 AS INTEGER) AS day_of_week"]
    for c in FEATURE_COLUMNS:
        t = "INTEGER" if c == "nbr_trades" else "DOUBLE"
        sel.append(f"CAST(d.{c} AS {t}) AS {drv}_{c}")
    joins = []
    for i, m in enumerate(others):
        a = f"o{i}"
        for c in FEATURE_COLUMNS:
            t = "INTEGER" if c == "nbr_trades" else "DOUBLE"
            sel.append(f"CAST(COALESCE({a}.{c}, 0) AS {t}) AS {m}_{c}")
        joins.append(f"LEFT JOIN (SELECT * FROM rolled WHERE market = {_q(m)}) {a} ON {a}.close_time = d.close_time")
    q["stream_wide_upsert"] = with_bars(
        f"SELECT {', '.join(sel)} FROM (SELECT * FROM rolled WHERE market = {_q(drv)}) d\n" + "\n".join(joins),
        extra=rolled)
    q["stream_final_wide"] = q["stream_wide_upsert"]
    late = (f"market = {_q(others[0])} AND (datetime // 3600000) % 6 = 5 AND (datetime - min(datetime) OVER ()) // "
            "((max(datetime) OVER () - min(datetime) OVER ()) // 4 + 1) < 2")
    q["stream_late_rows"] = with_bars(f"SELECT market, CASE WHEN {late} THEN 'late' ELSE 'final' END AS side, 1 AS one FROM bars WHERE market IN ({FEATS_IN})")
    q["stream_late_rows"] = f"SELECT market, side, count(*) AS n FROM ({q['stream_late_rows']}) GROUP BY 1, 2"
    return q
