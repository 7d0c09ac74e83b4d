"""Time arithmetic kept zone-free: epoch offsets are measured on TIMESTAMP_NTZ
wall clocks, so results do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(a, b) -> Column:
    """Exact integer floor division of bigint columns (b > 0)."""
    a, b = _c(a), (F.lit(b) if isinstance(b, int) else _c(b))
    return ((a - F.pmod(a, b)) / b).cast("bigint")


def epoch_us(ts) -> Column:
    """TIMESTAMP_NTZ (or TIMESTAMP) → microseconds since the epoch, read as UTC wall time."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(ts).cast("timestamp_ntz"))


def epoch_ms(ts) -> Column:
    """Timestamp → epoch milliseconds, floored."""
    return floor_div(epoch_us(ts), 1000)


def ms_to_ntz(ms, zone: str = "UTC") -> Column:
    """Epoch milliseconds → local wall clock of ``zone`` as TIMESTAMP_NTZ."""
    ts = F.timestamp_add("MILLISECOND", _c(ms).cast("bigint"), F.expr(_EPOCH))
    if zone.upper() != "UTC":
        ts = F.from_utc_timestamp(ts.cast("timestamp"), zone).cast("timestamp_ntz")
    return ts


def day_of_week(d, monday: int = 1) -> Column:
    """Day of week with Monday = ``monday`` (1 in training data, 0 in stream/serving)."""
    return (F.weekday(_c(d)) + F.lit(monday)).cast("int")


def calendar_columns(d, monday: int = 1) -> list[Column]:
    """year, month, day, day_of_week of a date/timestamp."""
    d = _c(d)
    return [F.year(d).cast("int").alias("year"), F.month(d).cast("int").alias("month"),
            F.dayofmonth(d).cast("int").alias("day"), day_of_week(d, monday).alias("day_of_week")]


def serving_bounds(as_of, days: int = 7):
    """(start_ms, end_ms, end_day) of the serving window.

    ``end_day`` is the midnight after ``as_of``; the window starts ``days-1``
    days earlier, and both ends are inclusive in the filter that uses them.
    """
    end_day = F.date_add(F.to_date(_c(as_of)), 1)
    start_day = F.date_sub(end_day, days - 1)
    start_ms = epoch_ms(start_day.cast("timestamp_ntz"))
    end_ms = epoch_ms(end_day.cast("timestamp_ntz"))
    return start_ms, end_ms, end_day
