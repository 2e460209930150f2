"""FX trend signals: changes, volatility, trend and stress per pair."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.metrics import abs_change, any_of, pct_change, rolling_volatility
from tidegauge.operators.series import BLOCK_ROWS, over_long_series
from tidegauge.sources.schemas import columns_of

# The volatility at a row covers 30 daily changes, hence 31 rates.
LOOK_BACK = 30
ORDER = ("rate_date", "rate_timestamp", "base_currency", "quote_currency")


@dataclass(frozen=True)
class FxThresholds:
    trend_pct: float = 0.25
    daily_change_pct: float = 0.75
    return_30d_pct: float = 2.5
    volatility: float = 5.0


def _changes(rates: DataFrame, partition: Sequence[str]) -> DataFrame:
    series = Window.partitionBy(*partition).orderBy(*ORDER)
    rate = F.col("rate")

    def change_over(rows: int):
        return pct_change(rate, F.lag(rate, rows).over(series), 6)

    return rates.withColumns(
        {
            "daily_change": abs_change(rate, F.lag(rate, 1).over(series), 8),
            "daily_change_pct": change_over(1),
            "weekly_change_pct": change_over(5),
            "return_30d_pct": change_over(LOOK_BACK),
        }
    ).withColumn(
        "rolling_30d_volatility",
        rolling_volatility(F.col("daily_change_pct"), series.rowsBetween(-29, 0), 6),
    )


def fx_trends(
    silver: DataFrame, thresholds: FxThresholds = FxThresholds(), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per rate; offsets count observed rates of the pair.

    Intraday stamps are kept, so a pair's series is not bounded by the calendar;
    it is cut into blocks of ``block_rows`` rates for the windows.
    """
    rates = silver.withColumn("rate", F.col("rate").cast("double"))
    change = F.col("daily_change_pct")
    return (
        over_long_series(
            rates,
            ["currency_pair"],
            ORDER,
            F.date_trunc("hour", "rate_timestamp"),
            F.date_trunc("second", "rate_timestamp"),
            LOOK_BACK,
            _changes,
            block_rows,
        )
        .withColumns(
            {
                "trend_signal": F.when(change >= thresholds.trend_pct, "strengthening")
                .when(change <= -thresholds.trend_pct, "weakening")
                .otherwise("stable"),
                "stress_flag": any_of(
                    F.abs(change) >= thresholds.daily_change_pct,
                    F.abs("return_30d_pct") >= thresholds.return_30d_pct,
                    F.col("rolling_30d_volatility") >= thresholds.volatility,
                ),
            }
        )
        .select(*columns_of("fx_trend_signals"))
    )
