"""Sections of the risk briefing, each a small table over Gold."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.metrics import exact_avg
from tidegauge.operators.latest import ascending, descending, latest_rows, top_rows

Gold = Mapping[str, DataFrame]

TOP = 10
MACRO_TOP = 15


def latest_dates(gold: Gold) -> DataFrame:
    """Newest date of four Gold tables, side by side."""
    dates = {
        "regime_as_of_date": ("cross_signal_summary", "as_of_date"),
        "market_snapshot_date": ("daily_market_snapshot", "snapshot_date"),
        "fx_rate_date": ("fx_trend_signals", "rate_date"),
        "movers_as_of_date": ("top_movers_why", "as_of_date"),
    }
    newest = [
        gold[table].agg(F.max(column).alias("d")).select(F.lit(name).alias("name"), "d")
        for name, (table, column) in dates.items()
    ]
    return reduce(DataFrame.unionAll, newest).agg(
        *[
            F.max(F.when(F.col("name") == name, F.col("d").cast("string"))).alias(name)
            for name in dates
        ]
    )


# Columns of the briefing sections, here and below.
REGIME_COLUMNS = (
    "as_of_date",
    "risk_regime",
    "market_stress_symbols",
    "market_up_symbols",
    "market_down_symbols",
    "fx_stress_pairs",
    "fx_strengthening_pairs",
    "fx_weakening_pairs",
    "macro_up_indicators",
    "macro_down_indicators",
    "market_avg_day_change_pct",
    "market_avg_return_30d_pct",
    "fx_avg_daily_change_pct",
    "fx_avg_return_30d_pct",
    "macro_avg_period_change_pct",
    "macro_avg_year_over_year_pct",
)


def order_of(section: str) -> list[Column]:
    """The order of a section's rows; empty for sections of one row."""
    return {
        "regime": [descending("as_of_date")],
        "top_movers": [ascending("return_30d_pct"), ascending("symbol")],
        "market_stress": [
            descending("stress_flag"),
            ascending("drawdown_from_90d_high_pct"),
            descending("rolling_30d_volatility"),
            ascending("symbol"),
        ],
        "fx_watchlist": [
            descending("stress_flag"),
            descending(F.abs("return_30d_pct")),
            descending("rolling_30d_volatility"),
            ascending("currency_pair"),
        ],
        "macro_trends": [descending("observation_date"), ascending("country_code"), ascending("indicator_name")],
        "fx_history_summary": [
            descending("observations"),
            descending("avg_rolling_30d_volatility"),
            ascending("currency_pair"),
        ],
    }.get(section, [])


def regime(gold: Gold) -> DataFrame:
    return top_rows(gold["cross_signal_summary"].select(*REGIME_COLUMNS), 1, *order_of("regime"))


def top_movers(gold: Gold) -> DataFrame:
    newest = latest_rows(gold["top_movers_why"], "as_of_date")
    return top_rows(newest, TOP, *order_of("top_movers"))


def market_breadth(gold: Gold) -> DataFrame:
    newest = latest_rows(gold["daily_market_snapshot"], "snapshot_date")

    def mean(column: str) -> Column:
        return F.round(exact_avg(F.col(column), 4), 4).alias(f"avg_{column}")

    return newest.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("symbols_in_snapshot"),
        F.count_if(F.col("day_change_pct") > 0).alias("advancing_symbols"),
        F.count_if(F.col("day_change_pct") < 0).alias("declining_symbols"),
        F.count_if("stress_flag").alias("stressed_symbols"),
        mean("day_change_pct"),
        mean("return_30d_pct"),
        mean("return_90d_pct"),
        mean("rolling_30d_volatility"),
    )


def market_stress(gold: Gold) -> DataFrame:
    newest = latest_rows(gold["daily_market_snapshot"], "snapshot_date").select(
        "symbol",
        "snapshot_date",
        "latest_price",
        "day_change_pct",
        "return_30d_pct",
        "return_90d_pct",
        "rolling_30d_volatility",
        "drawdown_from_90d_high_pct",
        "stress_flag",
        "currency",
    )
    return top_rows(newest, TOP, *order_of("market_stress"))


FX_COLUMNS = (
    "currency_pair",
    "rate_date",
    "rate",
    "daily_change_pct",
    "weekly_change_pct",
    "return_30d_pct",
    "rolling_30d_volatility",
    "trend_signal",
    "stress_flag",
)


def fx_watchlist(gold: Gold) -> DataFrame:
    newest = latest_rows(gold["fx_trend_signals"], "rate_date").select(*FX_COLUMNS)
    return top_rows(newest, TOP, *order_of("fx_watchlist"))


MACRO_COLUMNS = (
    "country_code",
    "indicator_name",
    "observation_date",
    "observation_value",
    "period_change_pct",
    "year_over_year_pct",
    "trend_direction",
)


def macro_trends(gold: Gold) -> DataFrame:
    newest = latest_rows(gold["macro_indicator_trends"], "observation_date").select(*MACRO_COLUMNS)
    return top_rows(newest, MACRO_TOP, *order_of("macro_trends"))


def _coverage(df: DataFrame, day: str, first: str, last: str, **distinct: str) -> DataFrame:
    return df.agg(
        F.min(day).alias(first),
        F.max(day).alias(last),
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_distinct(column).alias(name) for name, column in distinct.items()],
    )


def market_coverage(gold: Gold) -> DataFrame:
    return _coverage(
        gold["daily_market_snapshot"],
        "snapshot_date",
        "first_snapshot_date",
        "latest_snapshot_date",
        distinct_symbols="symbol",
        distinct_snapshot_dates="snapshot_date",
        distinct_currencies="currency",
    )


def fx_coverage(gold: Gold) -> DataFrame:
    return _coverage(
        gold["fx_trend_signals"],
        "rate_date",
        "first_rate_date",
        "latest_rate_date",
        distinct_currency_pairs="currency_pair",
        distinct_rate_dates="rate_date",
    )


def fx_history_summary(gold: Gold) -> DataFrame:
    per_pair = gold["fx_trend_signals"].groupBy("currency_pair").agg(
        F.min("rate_date").alias("first_rate_date"),
        F.max("rate_date").alias("latest_rate_date"),
        F.count(F.lit(1)).alias("observations"),
        exact_avg(F.abs("daily_change_pct"), 6).alias("avg_abs_daily_change_pct"),
        exact_avg(F.col("rolling_30d_volatility"), 6).alias("avg_rolling_30d_volatility"),
        F.max(F.abs("return_30d_pct")).alias("max_abs_return_30d_pct"),
    )
    top = top_rows(per_pair, TOP, *order_of("fx_history_summary"))
    rounded = ("avg_abs_daily_change_pct", "avg_rolling_30d_volatility", "max_abs_return_30d_pct")
    return top.withColumns({c: F.round(c, 4) for c in rounded})


def macro_coverage(gold: Gold) -> DataFrame:
    return _coverage(
        gold["macro_indicator_trends"],
        "observation_date",
        "first_observation_date",
        "latest_observation_date",
        distinct_countries="country_code",
        distinct_indicators="indicator_name",
        distinct_observation_dates="observation_date",
    )


SECTIONS: dict[str, Callable[[Gold], DataFrame]] = {
    "latest_dates": latest_dates,
    "regime": regime,
    "top_movers": top_movers,
    "market_breadth": market_breadth,
    "market_stress": market_stress,
    "fx_watchlist": fx_watchlist,
    "macro_trends": macro_trends,
}
HEAVY_SECTIONS: dict[str, Callable[[Gold], DataFrame]] = {
    "market_coverage": market_coverage,
    "fx_coverage": fx_coverage,
    "fx_history_summary": fx_history_summary,
    "macro_coverage": macro_coverage,
}


def _rows_as_json(name: str, section: DataFrame) -> DataFrame:
    """One row per section row: its place, and the row as JSON with nulls kept."""
    row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    # At most fifteen rows, so one task may number them.
    place = F.row_number().over(Window.orderBy(*(order_of(name) or [F.lit(1)]))) - 1
    return section.select(F.lit(name).alias("section"), place.cast("long").alias("place"), row.alias("row"))


Sections = Mapping[str, Callable[[Gold], DataFrame]]


def briefing_rows(gold: Gold, include_heavy: bool = False, heavy: Sections = HEAVY_SECTIONS) -> DataFrame:
    """``section, place, row`` of all sections; at most fifteen rows each."""
    sections = SECTIONS | (dict(heavy) if include_heavy else {})
    return reduce(
        DataFrame.unionAll, [_rows_as_json(name, build(gold)) for name, build in sections.items()]
    )


def briefing_json(gold: Gold, include_heavy: bool = False, heavy: Sections = HEAVY_SECTIONS) -> DataFrame:
    """The whole briefing as one JSON text.

    ``latest_dates`` is one object, every other section a list; the heavy
    sections are nested under ``heavy``. They may come from states
    (:data:`tidegauge.plans.report_states.HEAVY_SECTIONS`).
    """
    lists = (
        briefing_rows(gold, include_heavy, heavy)
        .groupBy("section")
        .agg(F.array_sort(F.collect_list(F.struct("place", "row"))).alias("rows"))
        .select("section", F.array_join(F.transform("rows", lambda r: r["row"]), ",").alias("body"))
    )

    def field(name: str, as_list: bool = True) -> Column:
        body = F.coalesce(F.max(F.when(F.col("section") == name, F.col("body"))), F.lit(""))
        opening, closing = ("[", "]") if as_list else ("", "")
        return F.concat(F.lit(f'"{name}":{opening}'), body, F.lit(closing))

    fields = [field(name, name != "latest_dates") for name in SECTIONS]
    if include_heavy:
        nested = F.concat_ws(",", *[field(name) for name in HEAVY_SECTIONS])
        fields.append(F.concat(F.lit('"heavy":{'), nested, F.lit("}")))
    return lists.agg(
        F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")).alias("payload")
    )


def briefing_fields(briefing: DataFrame) -> DataFrame:
    """A briefing text parsed back: ``section, place, field``, and the value as a
    ``number``, or as a ``text`` where it is none."""
    names = [*SECTIONS, *(f"heavy.{name}" for name in HEAVY_SECTIONS)]

    def rows(name: str) -> Column:
        body = F.get_json_object("payload", f"$.{name}")
        listed = F.concat(F.lit("["), body, F.lit("]")) if name == "latest_dates" else body
        return F.struct(
            F.lit(name.removeprefix("heavy.")).alias("section"),
            F.from_json(listed, "array<map<string,string>>").alias("rows"),
        )

    number = F.col("value").try_cast("double")
    return (
        briefing.select(F.inline(F.array(*[rows(n) for n in names])))
        .select("section", F.posexplode("rows").alias("place", "row"))
        .select("section", F.col("place").cast("long").alias("place"), F.explode("row").alias("field", "value"))
        .select(
            "section", "place", "field", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text")
        )
    )
