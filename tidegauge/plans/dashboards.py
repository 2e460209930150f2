"""Command-centre and walkthrough tables over all layers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.latest import (
    ascending,
    dedupe_latest,
    descending,
    latest_rows,
    top_rows,
)
from tidegauge.plans.briefing import FX_COLUMNS, MACRO_COLUMNS
from tidegauge.plans.checks import DATE_COLUMNS, MIN_HISTORY_DATES
from tidegauge.sources.schemas import columns_of

Tables = Mapping[str, DataFrame]

# Labels of the layer counts.
LAYER_LABELS = {
    "bronze_market": "market_prices_raw",
    "silver_market": "market_prices",
    "gold_market_snapshot": "daily_market_snapshot",
    "bronze_fx": "fx_rates_raw",
    "silver_fx": "fx_rates",
    "gold_fx_trends": "fx_trend_signals",
    "bronze_macro": "macro_indicators_raw",
    "silver_macro": "macro_indicators",
    "gold_macro_trends": "macro_indicator_trends",
    "gold_cross_signal_summary": "cross_signal_summary",
}
DATASET_LABELS = {
    "market": "market_prices",
    "fx": "fx_rates",
    "macro": "macro_indicators",
    "cross_signal_summary": "cross_signal_summary",
}
HISTORY_LABELS = {
    "market_history_days": "market_prices",
    "fx_history_days": "fx_rates",
    "macro_history_periods": "macro_indicators",
}
AUDIT_COLUMNS = ("pipeline_name", "status", "row_count", "run_timestamp", "message")


def kpis(tables: Tables) -> DataFrame:
    """Headline figures of the newest summary date."""
    return latest_rows(tables["cross_signal_summary"], "as_of_date").select(
        "as_of_date",
        "risk_regime",
        "market_stress_symbols",
        "fx_stress_pairs",
        "macro_up_indicators",
        "macro_down_indicators",
    )


# Columns of the dashboard and demo queries, here and below.
def trend(tables: Tables, dates: int = 30) -> DataFrame:
    recent = tables["cross_signal_summary"].select(
        "as_of_date",
        "market_avg_return_30d_pct",
        "fx_stress_pairs",
        "macro_up_indicators",
        "macro_down_indicators",
        "risk_regime",
    )
    return top_rows(recent, dates, descending("as_of_date"))


def movers(tables: Tables, rows: int = 20) -> DataFrame:
    found = tables["top_movers_why"].select(*columns_of("top_movers_why"))
    return top_rows(
        found, rows, descending("as_of_date"), ascending("return_30d_pct"), ascending("symbol")
    )


def audit_health(audit: DataFrame) -> DataFrame:
    """Last run per job."""
    return (
        dedupe_latest(audit, ["pipeline_name"], ["run_timestamp"], ["message", "status", "row_count"])
        .select(*AUDIT_COLUMNS)
        .orderBy(descending("run_timestamp"), ascending("pipeline_name"))
    )


def audit_failures(audit: DataFrame, rows: int = 20) -> DataFrame:
    failed = audit.filter(F.col("status") == "FAILED").select(*AUDIT_COLUMNS)
    return top_rows(failed, rows, descending("run_timestamp"), ascending("pipeline_name"), ascending("message"))


def layer_counts(tables: Tables) -> DataFrame:
    counts = [
        tables[table].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(label).alias("layer_name"), "row_count"
        )
        for label, table in LAYER_LABELS.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def freshness(tables: Tables) -> DataFrame:
    newest = [
        tables[table]
        .agg(F.max(F.to_date(F.col(DATE_COLUMNS[table]))).alias("latest_date"))
        .select(F.lit(label).alias("dataset"), "latest_date")
        for label, table in DATASET_LABELS.items()
    ]
    return reduce(DataFrame.unionAll, newest)


def history_depth(tables: Tables) -> DataFrame:
    """Distinct dates of the three Silver tables, side by side."""
    assert set(HISTORY_LABELS.values()) == set(MIN_HISTORY_DATES)
    depths = [
        tables[table]
        .agg(F.count_distinct(F.to_date(F.col(DATE_COLUMNS[table]))).alias("n"))
        .select(F.lit(label).alias("label"), "n")
        for label, table in HISTORY_LABELS.items()
    ]
    return reduce(DataFrame.unionAll, depths).agg(
        *[F.max(F.when(F.col("label") == label, F.col("n"))).alias(label) for label in HISTORY_LABELS]
    )


def recent_regimes(tables: Tables, dates: int = 10) -> DataFrame:
    summary = tables["cross_signal_summary"].select(*columns_of("cross_signal_summary"))
    return top_rows(summary, dates, descending("as_of_date"))


def stressed_instruments(tables: Tables, rows: int = 10) -> DataFrame:
    newest = latest_rows(tables["daily_market_snapshot"], "snapshot_date").select(
        "symbol",
        "snapshot_date",
        "latest_price",
        "return_30d_pct",
        "return_90d_pct",
        "rolling_30d_volatility",
        "drawdown_from_90d_high_pct",
        "stress_flag",
    )
    return top_rows(
        newest,
        rows,
        descending("stress_flag"),
        ascending("drawdown_from_90d_high_pct"),
        ascending("return_30d_pct"),
        ascending("symbol"),
    )


def fx_signals(tables: Tables, rows: int = 10) -> DataFrame:
    newest = latest_rows(tables["fx_trend_signals"], "rate_date").select(*FX_COLUMNS)
    return top_rows(
        newest,
        rows,
        descending("stress_flag"),
        descending(F.abs("return_30d_pct")),
        descending(F.abs("daily_change_pct")),
        ascending("currency_pair"),
    )


def recent_macro(tables: Tables, rows: int = 15) -> DataFrame:
    return top_rows(
        tables["macro_indicator_trends"].select(*MACRO_COLUMNS),
        rows,
        descending("observation_date"),
        ascending("country_code"),
        ascending("indicator_name"),
    )


def recent_movers(tables: Tables, rows: int = 10) -> DataFrame:
    newest = latest_rows(tables["daily_market_snapshot"], "snapshot_date").select(
        "symbol", "snapshot_date", "return_30d_pct", "return_90d_pct", "rolling_30d_volatility"
    )
    return top_rows(newest, rows, ascending("return_30d_pct"), ascending("return_90d_pct"), ascending("symbol"))
