from tidemark.functions.timecols import (  # noqa: F401
    calendar_columns, day_of_week, epoch_ms, epoch_us, ms_to_ntz, serving_bounds,
)
from tidemark.functions.pricing import buy_signal, limit_price  # noqa: F401
