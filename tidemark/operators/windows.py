"""Trailing averages per key over row frames and event-time RANGE frames.

A window partitioned by market alone sends a market's whole history to one
task; with a handful of markets that is a handful of tasks and one of them may
hold a third of the data. Instead every row gets a time chunk
(``order // chunk_width``) and the window is partitioned by (key, chunk). The
rows a chunk's first frames reach back to (its *halo*) are copied into it,
flagged as not owned, and dropped after the window:

* RANGE frames of length R: a row at time t enters the running sum at t and
  leaves it at t + R + 1. Each row is exploded once into these two entries, and
  into the same two in every later chunk that starts in (t, t+R] (one, when
  width >= R); there it enters before the chunk's first row. A running decimal
  sum and count over (key, chunk) then give every frame: linear in the rows,
  whatever the frame holds, in one pass over the input.
* ROW frames of n rows: only the last n-1 rows of a chunk (its *tail*) can be
  in a later chunk's halo, and the n-1 rows before a chunk are exactly the n-1
  tail rows before the chunk's first tail row. Tails are at most
  (n-1) × chunks per key — bounded by time span / width, not by data volume —
  so one look-ahead window over the tails of a key finds, for each tail row,
  the later chunks it must be copied to.

Both are exact. Averages go through a decimal sum divided by the row count, so
the result does not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timecols import MS_PER_DAY, floor_div
from tidemark.schemas import PRICE_DECIMAL

# Row frames: a chunk should hold many more rows than the frame (7 days of
# hourly bars = 168 rows per market-chunk, halo 6). RANGE frames: chunks of
# RANGE_CHUNK_FACTOR × the frame length, so the copied halo is at most 1/4 of
# the data (a width of one day under a 7-day frame would copy rows 7 times).
DEFAULT_CHUNK_MS = 7 * MS_PER_DAY
RANGE_CHUNK_FACTOR = 4
_OWN, _CHUNK, _POS = "_tm_own", "_tm_chunk", "_tm_pos"
RUNNING_DECIMAL = "decimal(38,8)"      # running sums over all rows of a key
_ENTRIES = f"array<struct<chunk:bigint,at:bigint,v:{PRICE_DECIMAL},n:bigint,own:boolean>>"


def exact_mean(value: str, w) -> Column:
    """Mean over a window frame computed as decimal sum / count (order-free)."""
    s = F.sum(F.col(value).cast(PRICE_DECIMAL)).over(w).cast("double")
    return s / F.count(F.col(value)).over(w)


def chunk_width_for(df: DataFrame, key: str, order: str, rows_per_chunk: int = 2_000_000,
                    minimum: int = 1) -> int:
    """Chunk width (in ``order`` units) giving the densest key about
    ``rows_per_chunk`` rows per chunk: one partial aggregate, one row back."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                                  (F.max(order) - F.min(order) + F.lit(1)).alias("span"))
    r = per_key.agg(F.max(F.col("n") / F.col("span")).alias("density")).first()
    density = r["density"] or 0.0
    if density <= 0:
        return max(minimum, DEFAULT_CHUNK_MS)
    return max(minimum, int(rows_per_chunk / density))


def _resolve(df: DataFrame, key: str, order: str, width) -> int:
    return chunk_width_for(df, key, order) if width == "auto" else int(width)


def _with_chunk(df: DataFrame, order: str, width: int) -> DataFrame:
    return df.withColumn(_CHUNK, floor_div(order, width))


def trailing_mean_rows(df: DataFrame, key: str, order: str, value: str, rows: int,
                       out: str, chunk_width: int | str = DEFAULT_CHUNK_MS) -> DataFrame:
    """``avg(value) OVER (PARTITION BY key ORDER BY order ROWS rows-1 PRECEDING)``.

    Frames at the start of a key are shorter (as in SQL). ``order`` must be
    unique within ``key`` (the bar contract) for the result to be defined.
    ``chunk_width="auto"`` sizes chunks from the densest key (see chunk_width_for).
    """
    chunk_width = _resolve(df, key, order, chunk_width)
    k = rows - 1
    base = _with_chunk(df, order, chunk_width).withColumn(_OWN, F.lit(True))
    if k <= 0:
        return df.withColumn(out, F.col(value).cast("double"))
    cols = [key, order, value]
    # Tail: the last k rows of every (key, chunk) (a partial WindowGroupLimit
    # runs before the shuffle, so only tail candidates move).
    desc = Window.partitionBy(key, _CHUNK).orderBy(F.col(order).desc())
    tails = (base.select(*cols, _CHUNK)
             .withColumn("_rn", F.row_number().over(desc))
             .filter(F.col("_rn") <= k).drop("_rn"))
    # A tail row belongs to the halo of every later chunk whose first tail row
    # is among the next k tail rows of the key: the chunks seen in that
    # look-ahead, minus its own. Tails per key are <= k x chunks per key.
    ahead = Window.partitionBy(key).orderBy(order).rowsBetween(1, k)
    targets = F.array_remove(F.collect_set(_CHUNK).over(ahead), F.col(_CHUNK))
    halo = (tails.withColumn("_ts", targets).withColumn("_t", F.explode("_ts"))
            .select(*cols, F.col("_t").alias(_CHUNK), F.lit(False).alias(_OWN)))
    return _window_and_keep(base, halo, key, order, value, out,
                            Window.partitionBy(key, _CHUNK).orderBy(order).rowsBetween(-k, 0))


def trailing_mean_range(df: DataFrame, key: str, order: str, value: str, length: int,
                        out: str, chunk_width: int | str | None = None) -> DataFrame:
    """``avg(value) OVER (PARTITION BY key ORDER BY order RANGE length PRECEDING)``,
    ``order`` numeric (epoch ms); peers with equal ``order`` are included.

    ``chunk_width``: by default 4 × the frame; ``"auto"`` follows the densest key.
    Chunks no wider than the frame take prefix sums on two levels."""
    if chunk_width is None:
        chunk_width = max(1, RANGE_CHUNK_FACTOR * length)
    width = max(1, _resolve(df, key, order, chunk_width))
    narrow = width <= length
    t, v = F.col(order).cast("long"), F.col(value).cast(PRICE_DECIMAL)
    own, leaves = floor_div(order, width), t + F.lit(length + 1)
    # in wide chunks an entry leaves in the chunk its frame ends in; if t + R + 1 is the next chunk's start it leaves nothing there
    last = floor_div(F.col(order) + F.lit(length + 1 if narrow else length), width)

    def entry(chunk, at, sign, owner: bool):
        return F.struct(chunk.cast("long").alias("chunk"), at.alias("at"), (v * F.lit(sign).cast("decimal(1,0)")).cast(PRICE_DECIMAL).alias("v"),
                        F.when(v.isNull(), 0).otherwise(sign).cast("long").alias("n"), F.lit(owner).alias("own"))

    none = F.array().cast(_ENTRIES)
    # a row without ``order`` has only its own entry: its frame is its peers
    parts = [F.array(entry(own, t, 1, True)), F.coalesce(F.when(t.isNotNull(), F.array(entry(last, leaves, -1, False))), none)]
    if not narrow:
        later = F.coalesce(F.when(last > own, F.sequence(own + 1, last)), F.array().cast("array<long>"))
        parts.insert(1, F.transform(later, lambda c: entry(c, c * F.lit(width) - F.lit(1), 1, False)))
    exploded = df.select("*", F.explode(F.concat(*parts)).alias("_tm_e"))
    fields = [F.col("_tm_e.chunk").alias(_CHUNK), F.col("_tm_e.at").alias(_POS), F.col("_tm_e.v").cast(RUNNING_DECIMAL).alias("_tm_v"),
              F.col("_tm_e.n").alias("_tm_n"), F.col("_tm_e.own").alias(_OWN)]
    kept = exploded.select(key, *[F.when(F.col("_tm_e.own"), F.col(c)).alias(c) for c in df.columns if c != key], *fields)
    if narrow:
        kept = kept.unionByName(_chunk_bases(exploded.select(key, *fields), key, width), allowMissingColumns=True)
    w = Window.partitionBy(key, _CHUNK).orderBy(_POS).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    total, count = F.sum("_tm_v").over(w), F.sum("_tm_n").over(w)
    return (kept.withColumn(out, F.when(count > 0, total.cast("double") / count))
            .filter(F.col(_OWN)).select(*[c for c in df.columns if c != out], out))


def _chunk_bases(entries: DataFrame, key: str, width: int) -> DataFrame:
    """One entry for each (key, chunk), before the chunk's first row: the sum of
    all entries of the key's earlier chunks. The running sum is over chunks, not
    rows: as many as the key's time span has chunks that hold something."""
    totals = entries.filter(F.col(_CHUNK).isNotNull()).groupBy(key, _CHUNK).agg(F.sum("_tm_v").alias("_tm_v"), F.sum("_tm_n").alias("_tm_n"))
    before = Window.partitionBy(key).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, _CHUNK, (F.col(_CHUNK) * F.lit(width) - F.lit(1)).alias(_POS), F.sum("_tm_v").over(before).cast(RUNNING_DECIMAL).alias("_tm_v"),
                         F.sum("_tm_n").over(before).alias("_tm_n"), F.lit(False).alias(_OWN))


def _window_and_keep(base: DataFrame, halo: DataFrame, key: str, order: str, value: str,
                     out: str, w) -> DataFrame:
    halo_full = halo
    for c in base.columns:
        if c not in halo_full.columns:
            halo_full = halo_full.withColumn(c, F.lit(None).cast(base.schema[c].dataType))
    both = base.unionByName(halo_full.select(*base.columns))
    return (both.withColumn(out, exact_mean(value, w))
            .filter(F.col(_OWN)).drop(_OWN, _CHUNK))


def trailing_mean_rows_plain(df: DataFrame, key: str, order: str, value: str, rows: int,
                             out: str) -> DataFrame:
    """Single-window form (one task per key); reference for tests and small keys."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, exact_mean(value, w))


def trailing_mean_range_plain(df: DataFrame, key: str, order: str, value: str, length: int,
                              out: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order).rangeBetween(-length, 0)
    return df.withColumn(out, exact_mean(value, w))


def point_mean(df: DataFrame, key: str, order: str, value: str, out: str = "avg_close") -> DataFrame:
    """Filter-then-window as literally written (W4): once the frame is cut down to
    one (key, time) the 7-day window only sees peers of that instant, so it is
    the mean per (key, time) — a plain aggregate, no window needed."""
    return (df.groupBy(key, order)
            .agg((F.sum(F.col(value).cast(PRICE_DECIMAL)).cast("double")
                  / F.count(value)).alias(out)))
