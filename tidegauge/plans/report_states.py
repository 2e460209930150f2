"""Reports and checks from states that add up, one row per month and series.

A state holds counts, first and last dates, days as a bit mask, extremes, sums of exact
means, and what the newest date has. A date falls in one month, so months merge by
plain sums, extremes and ORs, and distinct days of a table are the sum over its months.
When a month's rows change, its state is built anew from that month alone; all others
stay. The reports and checks here return what those of the same name return over the
tables themselves, and read no row of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.metrics import mean_of, mean_state
from tidegauge.operators.latest import top_rows
from tidegauge.plans import checks
from tidegauge.plans.briefing import TOP, order_of
from tidegauge.plans.checks import BUSINESS_KEYS, DATE_COLUMNS, FX_METRIC_ROWS, MARKET_METRIC_ROWS, SERIES_METRICS
from tidegauge.plans.dashboards import DATASET_LABELS, HISTORY_LABELS, LAYER_LABELS
from tidegauge.sources.schemas import MONTH_OF, TABLES

Tables = Mapping[str, DataFrame]

#: Decimals of the metrics whose means are kept.
MARKET_MEANS = {"return_30d_pct": 4, "rolling_30d_volatility": 4, "drawdown_from_90d_high_pct": 4}
FX_MEANS = {"abs_daily_change_pct": 6, "rolling_30d_volatility": 6}
MACRO_MEANS = {"year_over_year_pct": 4}


def _month(table: str) -> Column:
    return F.date_format(MONTH_OF[table], "yyyy-MM").alias("month")


def days_of(day: Column) -> Column:
    """A bit per day of the month; a null day has none."""
    return F.coalesce(F.bit_or(F.call_function("shiftleft", F.lit(1), F.dayofmonth(day) - 1)), F.lit(0))


def _span(day: str) -> list[Column]:
    return [
        F.min(day).alias("first_date"), F.max(day).alias("last_date"),
        F.count(F.lit(1)).alias("row_count"), days_of(F.col(day)).alias("days"),
    ]


def _at_newest(day: str, metrics: Sequence[str]) -> list[Column]:
    """Whether a row of the newest date has the metric: the greatest date, then true."""
    return [F.max(F.struct(day, F.col(m).isNotNull().alias("has")))["has"].alias(f"has_{m}") for m in metrics]


def _means(means: Mapping[str, int], **values: Column) -> list[Column]:
    return [
        part.alias(f"{name}__{kind}")
        for name, digits in means.items()
        for kind, part in mean_state(values.get(name, F.col(name)), digits).items()
    ]


def silver_months(table: str) -> Callable[[DataFrame], DataFrame]:
    """Rows, newest day, days and duplicate keys per month. A key holds its date, so
    keys that occur twice do so within a month, and the month follows from the day."""

    def build(rows: DataFrame) -> DataFrame:
        day = F.to_date(F.col(DATE_COLUMNS[table]))
        per_key = rows.groupBy(*BUSINESS_KEYS[table]).agg(F.count(F.lit(1)).alias("copies"), F.max(day).alias("day"))
        return per_key.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
            F.sum("copies").alias("row_count"), F.max("day").alias("newest"),
            days_of(F.col("day")).alias("days"), F.count_if(F.col("copies") > 1).alias("duplicate_keys"),
        )

    return build


def market_months(market: DataFrame) -> DataFrame:
    return market.groupBy(_month("daily_market_snapshot"), "symbol").agg(
        *_span("snapshot_date"),
        F.count_if("stress_flag").alias("stressed"),
        F.array_sort(F.collect_set("currency")).alias("currencies"),
        *_at_newest("snapshot_date", list(MARKET_METRIC_ROWS)),
        *_means(MARKET_MEANS),
    )


def fx_months(fx: DataFrame) -> DataFrame:
    return fx.groupBy(_month("fx_trend_signals"), "currency_pair").agg(
        *_span("rate_date"),
        F.count("stress_flag").alias("flagged"),
        F.max(F.abs("return_30d_pct")).alias("max_abs_return_30d_pct"),
        *_at_newest("rate_date", list(FX_METRIC_ROWS)),
        *_means(FX_MEANS, abs_daily_change_pct=F.abs("daily_change_pct")),
    )


def macro_months(macro: DataFrame) -> DataFrame:
    by = ("country_code", "indicator_name", "trend_direction")
    return macro.groupBy(_month("macro_indicator_trends"), *by).agg(*_span("observation_date"), *_means(MACRO_MEANS))


# State -> the table it is kept of and its builder.
BUILDERS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    **{f"{table}_months": (table, silver_months(table)) for table in BUSINESS_KEYS},
    "market_report_months": ("daily_market_snapshot", market_months),
    "fx_report_months": ("fx_trend_signals", fx_months),
    "macro_report_months": ("macro_indicator_trends", macro_months),
}
STATE_OF = {table: state for state, (table, _) in BUILDERS.items()}


def _mean(name: str, digits: int) -> Column:
    return mean_of({kind: F.sum(f"{name}__{kind}") for kind in ("n", "whole", "rest", "large")}, digits)


def _distinct_days(states: DataFrame, name: str) -> DataFrame:
    """Distinct days over all months: series of a month by OR, months by sum."""
    months = states.groupBy("month").agg(F.bit_count(F.bit_or("days")).alias("_days"))
    return months.agg(F.coalesce(F.sum("_days"), F.lit(0)).cast("long").alias(name))


def _coverage(states: DataFrame, first: str, last: str, days: str, **distinct: str) -> DataFrame:
    spans = states.agg(
        F.min("first_date").alias(first),
        F.max("last_date").alias(last),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        *[F.count_distinct(column).alias(name) for name, column in distinct.items()],
    )
    return spans.withColumn(days, _distinct_days(states, days).scalar())


def market_coverage(tables: Tables) -> DataFrame:
    states = tables["market_report_months"]
    listed = states.select(F.explode("currencies").alias("currency"))
    currencies = listed.agg(F.count_distinct("currency")).scalar()
    return _coverage(
        states, "first_snapshot_date", "latest_snapshot_date", "distinct_snapshot_dates", distinct_symbols="symbol"
    ).withColumn("distinct_currencies", currencies)


def fx_coverage(tables: Tables) -> DataFrame:
    return _coverage(
        tables["fx_report_months"],
        "first_rate_date", "latest_rate_date", "distinct_rate_dates", distinct_currency_pairs="currency_pair",
    )


def macro_coverage(tables: Tables) -> DataFrame:
    return _coverage(
        tables["macro_report_months"],
        "first_observation_date", "latest_observation_date", "distinct_observation_dates",
        distinct_countries="country_code", distinct_indicators="indicator_name",
    )


def fx_history_summary(tables: Tables) -> DataFrame:
    per_pair = tables["fx_report_months"].groupBy("currency_pair").agg(
        F.min("first_date").alias("first_rate_date"),
        F.max("last_date").alias("latest_rate_date"),
        F.sum("row_count").alias("observations"),
        *[_mean(name, digits).alias(f"avg_{name}") for name, digits in FX_MEANS.items()],
        F.max("max_abs_return_30d_pct").alias("max_abs_return_30d_pct"),
    )
    top = top_rows(per_pair, TOP, *order_of("fx_history_summary"))
    rounded = ("avg_abs_daily_change_pct", "avg_rolling_30d_volatility", "max_abs_return_30d_pct")
    return top.withColumns({c: F.round(c, 4) for c in rounded})


#: Sections of the briefing that cover the whole history.
HEAVY_SECTIONS: dict[str, Callable[[Tables], DataFrame]] = {
    "market_coverage": market_coverage,
    "fx_coverage": fx_coverage,
    "fx_history_summary": fx_history_summary,
    "macro_coverage": macro_coverage,
}


def risk_return_by_symbol(tables: Tables) -> DataFrame:
    return tables["market_report_months"].groupBy("symbol").agg(
        *[_mean(name, MARKET_MEANS[name]).alias(f"avg_{name}") for name in ("return_30d_pct", "rolling_30d_volatility")],
        F.abs(_mean("drawdown_from_90d_high_pct", 4)).alias("abs_drawdown_pct"),
    )


def yoy_by_indicator_and_trend(tables: Tables) -> DataFrame:
    by = tables["macro_report_months"].groupBy("indicator_name", "trend_direction")
    return by.agg(_mean("year_over_year_pct", 4).alias("avg_year_over_year_pct"))


def stressed_pairs_card(tables: Tables) -> DataFrame:
    return tables["fx_report_months"].agg(F.coalesce(F.sum("flagged"), F.lit(0)).alias("stressed_pairs"))


def stress_count(tables: Tables) -> DataFrame:
    return tables["market_report_months"].groupBy("symbol").agg(F.sum("stressed").alias("stress_count"))


def _rows() -> Column:
    return F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")


def facts(tables: Tables, table: str) -> DataFrame:
    """One row: ``rows``, and of Silver tables ``newest`` and ``dates`` as well.

    Raw tables are counted by the ledger. A table with a row per date is read itself.
    """
    if TABLES[table][0] == "bronze":
        of_table = tables["load_ledger"].filter(F.col("table_name") == table)
        shown = of_table.groupBy("load_id").agg(F.min(F.struct("part", "row_count"))["row_count"].alias("row_count"))
        return shown.agg(_rows())
    if table not in STATE_OF:
        return checks.table_facts(table, tables[table])
    states = tables[STATE_OF[table]]
    if table in BUSINESS_KEYS:
        months = F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).cast("long")
        return states.agg(_rows(), F.max("newest").alias("newest"), months.alias("dates"))
    return states.agg(_rows())


def layer_counts(tables: Tables) -> DataFrame:
    counts = [
        facts(tables, table).select(F.lit(label).alias("layer_name"), F.col("rows").alias("row_count"))
        for label, table in LAYER_LABELS.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def freshness(tables: Tables) -> DataFrame:
    newest = [
        facts(tables, table).select(F.lit(label).alias("dataset"), F.col("newest").alias("latest_date"))
        for label, table in DATASET_LABELS.items()
    ]
    return reduce(DataFrame.unionAll, newest)


def history_depth(tables: Tables) -> DataFrame:
    depths = [
        facts(tables, table).select(F.lit(label).alias("label"), F.col("dates").alias("n"))
        for label, table in HISTORY_LABELS.items()
    ]
    return reduce(DataFrame.unionAll, depths).agg(
        *[F.max(F.when(F.col("label") == label, F.col("n"))).alias(label) for label in HISTORY_LABELS]
    )


def lacking_series(tables: Tables, table: str) -> DataFrame:
    """Series whose newest date lacks a metric that its history allows."""
    key, day, metric_rows = SERIES_METRICS[table]
    seen = tables[STATE_OF[table]].select(
        key, F.col("last_date").alias(day), F.col("row_count").alias("rows"),
        *[F.col(f"has_{m}").alias(m) for m in metric_rows],
    )
    return checks.lacking_series(seen, key, day, metric_rows)


def run_checks(tables: Tables, as_of: str | date | None = None) -> DataFrame:
    """What :func:`tidegauge.plans.checks.run_checks` returns over all tables."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    names = [name for name in TABLES if name != "pipeline_runs"]
    parts = [checks.facts_checked(name, facts(tables, name), today) for name in names]
    for name in BUSINESS_KEYS:
        copies = tables[STATE_OF[name]].agg(F.coalesce(F.sum("duplicate_keys"), F.lit(0)).alias("n"))
        parts.append(checks.count_is_zero("duplicate_keys", name, copies))
    parts += [checks.none_of("missing_metrics", name, lacking_series(tables, name)) for name in SERIES_METRICS]
    parts += [checks.missing_values(name, tables[name]) for name in checks.NEVER_NULL]
    return reduce(DataFrame.unionAll, parts)


REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    **{f"briefing_{name}": build for name, build in HEAVY_SECTIONS.items()},
    "report_risk_return_by_symbol": risk_return_by_symbol,
    "report_yoy_by_indicator_and_trend": yoy_by_indicator_and_trend,
    "report_stressed_pairs_card": stressed_pairs_card,
    "measure_stress_count": stress_count,
    "demo_layer_counts": layer_counts,
    "demo_freshness": freshness,
    "demo_history_depth": history_depth,
}
