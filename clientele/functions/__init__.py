"""Column-level helpers: rounding, dates, ratios. All are built-in Spark expressions."""

from clientele.functions.numeric import (ceil_div, exact_mean, exact_sum, money,
                                         quantile_tile, round2, round_to, safe_ratio)
from clientele.functions.dates import (date_key, day_boundaries, month_boundaries,
                                       sql_server_week)

__all__ = [
    "ceil_div", "exact_mean", "exact_sum", "money", "quantile_tile", "round2", "round_to",
    "safe_ratio", "date_key", "day_boundaries", "month_boundaries", "sql_server_week",
]
