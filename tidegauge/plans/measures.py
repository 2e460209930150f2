"""Report measures, report averages and report views over Gold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.metrics import exact_avg
from tidegauge.operators.latest import latest_rows
from tidegauge.sources.schemas import TABLES, columns_of

Gold = Mapping[str, DataFrame]

CONSENSUS_RATIO = 1.5

# Columns a report view leaves out of its Gold table.
VIEW_OMITS = {
    "daily_market_snapshot": {"ingested_at"},
    "cross_signal_summary": set(),
    "fx_trend_signals": {"ingested_at"},
    "macro_indicator_trends": {"ingested_at"},
    "top_movers_why": set(),
}
# Detail tables and their date, many-to-one on the summary's date.
SPINE_DATES = {
    "daily_market_snapshot": "snapshot_date",
    "fx_trend_signals": "rate_date",
    "top_movers_why": "as_of_date",
}


def headline_measures(cross: DataFrame) -> DataFrame:
    """Regime, stress counts and breadth at the newest date, as one row."""

    def at_newest(column: str) -> Column:
        return F.max_by(column, "as_of_date")

    return cross.agg(
        at_newest("risk_regime").alias("current_regime"),
        at_newest("market_stress_symbols").alias("stressed_instruments"),
        F.try_divide(at_newest("market_up_symbols"), at_newest("market_symbols_count")).alias(
            "market_breadth_pct"
        ),
        at_newest("fx_stress_pairs").alias("fx_stressed_pairs"),
    )


def stress_count(market: DataFrame, *by: str) -> DataFrame:
    """Rows with the stress flag, for all rows or per group."""
    return market.groupBy(*by).agg(F.count_if("stress_flag").alias("stress_count"))


def drawdown_label(drawdown: Column) -> Column:
    return (
        F.when(drawdown <= -20, "Severe")
        .when(drawdown <= -10, "Moderate")
        .when(drawdown <= -5, "Mild")
        .otherwise("Near High")
    )


def drawdown_labels(market: DataFrame) -> DataFrame:
    drawdown = F.col("drawdown_from_90d_high_pct")
    return market.select(
        "symbol", "snapshot_date", drawdown, drawdown_label(drawdown).alias("drawdown_label")
    )


def macro_consensus(macro: DataFrame) -> DataFrame:
    """Direction of the newest observations: a 3:2 majority or ``Mixed``."""
    trend = F.col("trend_direction")
    up, down = F.col("up_indicators"), F.col("down_indicators")
    return (
        latest_rows(macro, "observation_date")
        .agg(
            F.count_if(trend == "up").alias("up_indicators"),
            F.count_if(trend == "down").alias("down_indicators"),
        )
        .withColumn(
            "macro_consensus",
            F.when(up > down * CONSENSUS_RATIO, "Expanding")
            .when(down > up * CONSENSUS_RATIO, "Contracting")
            .otherwise("Mixed"),
        )
    )


def mover_directions(movers: DataFrame) -> DataFrame:
    """Bar direction and length; a missing return counts as zero, so ``Up``."""
    month = F.col("return_30d_pct")
    return movers.select(
        "as_of_date",
        "symbol",
        F.when(F.coalesce(month, F.lit(0.0)) >= 0, "Up").otherwise("Down").alias("mover_direction"),
        F.abs(month).alias("abs_return_30d"),
    )


def report_avgs(gold: Gold) -> dict[str, DataFrame]:
    """The averages behind the report visuals, one table per visual."""
    market, fx, macro = (
        gold["daily_market_snapshot"],
        gold["fx_trend_signals"],
        gold["macro_indicator_trends"],
    )
    return {
        "risk_return_by_symbol": market.groupBy("symbol").agg(
            exact_avg(F.col("return_30d_pct"), 4).alias("avg_return_30d_pct"),
            exact_avg(F.col("rolling_30d_volatility"), 4).alias("avg_rolling_30d_volatility"),
            F.abs(exact_avg(F.col("drawdown_from_90d_high_pct"), 4)).alias("abs_drawdown_pct"),
        ),
        "rate_by_date_and_pair": fx.groupBy("rate_date", "currency_pair").agg(
            exact_avg(F.col("rate"), 5).alias("avg_rate")
        ),
        # The card counts non-null flags, stressed or not.
        "stressed_pairs_card": fx.agg(F.count("stress_flag").alias("stressed_pairs")),
        "yoy_by_indicator_and_trend": macro.groupBy("indicator_name", "trend_direction").agg(
            exact_avg(F.col("year_over_year_pct"), 4).alias("avg_year_over_year_pct")
        ),
        "value_by_date_and_indicator": macro.groupBy("observation_date", "indicator_name").agg(
            exact_avg(F.col("observation_value"), 2).alias("avg_observation_value")
        ),
        "movers_by_symbol_and_flag": gold["top_movers_why"].groupBy("symbol", "stress_flag").agg(
            exact_avg(F.col("return_30d_pct"), 4).alias("avg_return_30d_pct")
        ),
    }


def bi_view(gold: Gold, table: str) -> DataFrame:
    """A Gold table with the columns and types the report model declares."""
    declared = [column.split(" ", 1) for column in TABLES[table][1].split(", ")]
    return gold[table].select(
        *[F.col(name).cast(kind) for name, kind in declared if name not in VIEW_OMITS[table]]
    )


def date_spine_view(gold: Gold, table: str) -> DataFrame:
    """Rows of a detail table next to the regime and market return of their date."""
    day = SPINE_DATES[table]
    spine = gold["cross_signal_summary"].select(
        F.col("as_of_date").alias(day), "risk_regime", "market_avg_return_30d_pct"
    )
    return gold[table].select(*columns_of(table)).join(spine, day, "left")
