from bazaarlens.functions.numeric import (
    MONEY_TOTAL,
    cents,
    exact_mean,
    exact_ratio,
    from_cents,
    money_mean,
    money_sum,
    percent,
)
from bazaarlens.functions.timeops import elapsed_seconds, mean_days, month_label, month_of

__all__ = [
    "MONEY_TOTAL",
    "cents",
    "elapsed_seconds",
    "exact_mean",
    "exact_ratio",
    "from_cents",
    "mean_days",
    "money_mean",
    "money_sum",
    "month_label",
    "month_of",
    "percent",
]
