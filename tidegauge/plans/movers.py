"""Top movers of the latest market date, with a plain-text explanation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.latest import latest_value, top_rows
from tidegauge.plans.macro import SERIES_KEY
from tidegauge.sources.schemas import columns_of

MOVERS_PER_DIRECTION = 5

# The wording of the sentences below, and the returns they turn on.


def _sentence(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _counts(*names: str | Column) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _fx_sentence(*counts: str | Column) -> Column:
    up, down, stressed = _counts(*counts)
    return _sentence("FX context: ", up, " strengthening, ", down, " weakening, ", stressed, " stressed pairs.")


def _macro_sentence(*counts: str | Column) -> Column:
    up, down = _counts(*counts)
    return _sentence("Macro context: ", up, " up indicators, ", down, " down indicators.")


def fx_context(fx: DataFrame, as_of: Column) -> DataFrame:
    """One sentence on the pairs quoted exactly on that date."""
    trend = F.col("trend_signal")
    told = _fx_sentence(
        F.count_if(trend == "strengthening"), F.count_if(trend == "weakening"), F.count_if("stress_flag")
    )
    return fx.filter(F.col("rate_date") == as_of).agg(told.alias("fx_context"))


def macro_context(macro: DataFrame, as_of: Column) -> DataFrame:
    """One sentence on the last observation of every series up to that date."""
    trend = F.col("trend_direction")
    state = (
        macro.filter(F.col("observation_date") <= as_of)
        .groupBy(*SERIES_KEY)
        .agg(F.max_by("trend_direction", "observation_date").alias("trend_direction"))
    )
    return state.agg(_macro_sentence(F.count_if(trend == "up"), F.count_if(trend == "down")).alias("macro_context"))


def _why() -> Column:
    month = F.col("return_30d_pct")
    return F.concat_ws(
        " ",
        F.when(F.col("stress_flag"), "Market stress flag is active.").otherwise(
            "Market stress flag is not active."
        ),
        F.when(month <= -5.0, "30d return indicates material downside pressure.")
        .when(month >= 5.0, "30d return indicates strong positive momentum.")
        .otherwise("30d return is directionally moderate."),
        F.coalesce("fx_context", F.lit("FX context unavailable.")),
        F.coalesce("macro_context", F.lit("Macro context unavailable.")),
    )


def top_movers_why(
    market: DataFrame, fx: DataFrame, macro: DataFrame, k: int = MOVERS_PER_DIRECTION
) -> DataFrame:
    """Up to ``k`` strongest risers and fallers; a zero move is in neither list.

    The move is the 30-row return, the day change where that is missing. Ties go
    by symbol. Table order is no contract; readers sort.
    """
    as_of = latest_value(market, "snapshot_date")
    today = market.filter(F.col("snapshot_date") == as_of)
    return _movers(today, fx_context(fx, as_of).scalar(), macro_context(macro, as_of).scalar(), k)


def movers_of_summary(today: DataFrame, summary: DataFrame, k: int = MOVERS_PER_DIRECTION) -> DataFrame:
    """The same from the market's rows of its newest date and the summary, whose row of
    that date has the counts of both sentences: no detail row is read again."""
    as_of = latest_value(today, "snapshot_date")
    row = summary.filter(F.col("as_of_date") == as_of)
    fx = _fx_sentence("fx_strengthening_pairs", "fx_weakening_pairs", "fx_stress_pairs")
    macro = _macro_sentence("macro_up_indicators", "macro_down_indicators")
    return _movers(today, row.select(fx).scalar(), row.select(macro).scalar(), k)


def _movers(market: DataFrame, fx_told: Column, macro_told: Column, k: int) -> DataFrame:
    move = F.coalesce("return_30d_pct", "day_change_pct")
    today = market.select(
        F.col("snapshot_date").alias("as_of_date"),
        "symbol",
        "latest_price",
        "day_change_pct",
        "return_30d_pct",
        "stress_flag",
    )
    risers = top_rows(today.filter(move > 0), k, move.desc(), F.col("symbol").asc())
    fallers = top_rows(today.filter(move < 0), k, move.asc(), F.col("symbol").asc())
    return (
        risers.unionByName(fallers)
        .dropDuplicates(["as_of_date", "symbol"])
        .withColumns(
            {
                "fx_context": fx_told,
                "macro_context": macro_told,
            }
        )
        .withColumn("why_summary", _why())
        .select(*columns_of("top_movers_why"))
    )
