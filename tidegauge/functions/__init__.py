from tidegauge.functions.metrics import (
    abs_change,
    any_of,
    exact_avg,
    pct_change,
    rolling_volatility,
)
from tidegauge.functions.symbols import history_variants, map_ticker, suffix_or_us

__all__ = [
    "abs_change",
    "any_of",
    "exact_avg",
    "history_variants",
    "map_ticker",
    "pct_change",
    "rolling_volatility",
    "suffix_or_us",
]
