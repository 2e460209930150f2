"""Macro indicator trends per country and indicator."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.metrics import abs_change, pct_change
from tidegauge.operators.latest import dedupe_latest
from tidegauge.plans.silver import MACRO_KEY
from tidegauge.sources.schemas import columns_of

SERIES_KEY = ("country_code", "indicator_name")
TREND_LABELS = ("up", "down", "flat")
LEGACY_LABELS = ("increase", "decrease", "flat")


def _direction(change, labels):
    rising, falling, level = labels
    return F.when(change > 0, rising).when(change < 0, falling).otherwise(level)


def _time_column(silver: DataFrame) -> str:
    return "ingested_at" if "ingested_at" in silver.columns else "ingest_ts"


def macro_trends(
    silver: DataFrame, labels: tuple[str, str, str] = TREND_LABELS, time_column: str | None = None
) -> DataFrame:
    """One row per series and date; twelve observations back is the yearly base."""
    time_column = time_column or _time_column(silver)
    series = Window.partitionBy(*SERIES_KEY).orderBy("observation_date")
    value = F.col("observation_value")
    previous = F.lag(value, 1).over(series)
    latest = dedupe_latest(silver, MACRO_KEY, [time_column], ["observation_value"])
    return (
        latest.withColumn("observation_value", value.cast("double"))
        .withColumns(
            {
                "period_change": abs_change(value, previous, 6),
                "period_change_pct": pct_change(value, previous, 4),
                "year_over_year_pct": pct_change(value, F.lag(value, 12).over(series), 4),
                "ingested_at": F.col(time_column),
            }
        )
        .withColumn("trend_direction", _direction(F.col("period_change"), labels))
        .select(*columns_of("macro_indicator_trends"))
    )


def macro_trends_legacy(silver: DataFrame) -> DataFrame:
    """The superseded variant: unrounded change, other labels, all input columns."""
    series = Window.partitionBy(*SERIES_KEY).orderBy("observation_date")
    change = F.col("change_value")
    return (
        silver.withColumn("prev_value", F.lag("observation_value").over(series))
        .withColumn("change_value", F.col("observation_value") - F.col("prev_value"))
        .withColumns(
            {
                "change_pct": F.round(F.try_divide(change, F.col("prev_value")) * 100, 4),
                "trend_direction": _direction(change, LEGACY_LABELS),
            }
        )
    )
