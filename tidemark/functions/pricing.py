"""Decision and order-price helpers (F8, M2)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def limit_price(price, markup: float = 1.01, tick: float | None = 0.01,
                tick_col=None) -> Column:
    """Price × markup rounded to the tick precision, half-to-even on the binary value.

    A constant tick rounds to ``-log10(tick)`` decimals; a per-row tick column
    rounds to a multiple of that tick (``round`` needs a constant scale).
    """
    p = (F.col(price) if isinstance(price, str) else price) * F.lit(markup)
    if tick_col is not None:
        t = F.col(tick_col) if isinstance(tick_col, str) else tick_col
        return F.bround(p / t, 0) * t
    return F.bround(p, int(round(-math.log10(tick))))


def buy_signal(prediction, limit) -> Column:
    """Buy when the prediction is below the limit and not the 0 placeholder."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    lim = F.col(limit) if isinstance(limit, str) else F.lit(limit)
    return (p < lim) & (p != F.lit(0.0))
