from fleetworks.functions.columns import (
    coin,
    draw,
    hash24,
    logistic,
    lookup,
    prorate,
    safe_ratio,
)
from fleetworks.functions.dates import (
    day_number,
    elapsed_months,
    hours_between,
    iso_weekday,
    month_name,
    month_start,
    quarter_end,
    quarter_start,
)

__all__ = [
    "coin", "draw", "hash24", "logistic", "lookup", "prorate", "safe_ratio", "day_number", "elapsed_months", "hours_between",
    "iso_weekday", "month_name", "month_start", "quarter_end", "quarter_start",
]
