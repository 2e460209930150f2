"""Data-quality checks over all layers as one result table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.plans.silver import FX_KEY, MACRO_KEY, MARKET_KEY

# Limits of the checks.
MAX_AGE_DAYS = {
    "market_prices": 10,
    "fx_rates": 10,
    "macro_indicators": 1200,
    "cross_signal_summary": 10,
}
MIN_HISTORY_DATES = {"market_prices": 90, "fx_rates": 30, "macro_indicators": 8}
DATE_COLUMNS = {
    "market_prices": "market_time",
    "fx_rates": "rate_date",
    "macro_indicators": "observation_date",
    "cross_signal_summary": "as_of_date",
}
BUSINESS_KEYS = {
    "market_prices": MARKET_KEY,
    "fx_rates": FX_KEY,
    "macro_indicators": MACRO_KEY,
}
# Metric -> rows of history from which it must be present.
MARKET_METRIC_ROWS = {
    "return_7d_pct": 8,
    "return_30d_pct": 31,
    "return_90d_pct": 91,
    "rolling_30d_volatility": 31,
    "drawdown_from_90d_high_pct": 1,
}
FX_METRIC_ROWS = {
    "return_30d_pct": 31,
    "rolling_30d_volatility": 31,
    "trend_signal": 31,
    "stress_flag": 31,
}
SERIES_METRICS = {
    "daily_market_snapshot": ("symbol", "snapshot_date", MARKET_METRIC_ROWS),
    "fx_trend_signals": ("currency_pair", "rate_date", FX_METRIC_ROWS),
}
NEVER_NULL = {
    "cross_signal_summary": ("risk_regime",),
    "top_movers_why": ("why_summary", "fx_context", "macro_context"),
}


def _result(check: str, subject: str, value: Column, limit: int, passed: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(subject).alias("subject"),
        value.cast("long").alias("value"),
        F.lit(limit).cast("long").alias("threshold"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def facts_checked(name: str, facts: DataFrame, as_of: Column) -> DataFrame:
    """Checks of a table's one row of facts: ``rows``, ``newest`` and ``dates``, the
    latter two where the table has such checks."""
    results = [_result("non_empty", name, F.col("rows"), 0, F.col("rows") > 0)]
    if name in DATE_COLUMNS:
        age, limit = F.date_diff(as_of, F.col("newest")), MAX_AGE_DAYS[name]
        results.append(_result("freshness_days", name, age, limit, age <= limit))
        if name in MIN_HISTORY_DATES:
            depth, limit = F.col("dates"), MIN_HISTORY_DATES[name]
            results.append(_result("history_dates", name, depth, limit, depth >= limit))
    return facts.select(F.inline(F.array(*results)))


def table_facts(name: str, df: DataFrame) -> DataFrame:
    """Row count, newest date and history depth of a table from one pass over it."""
    facts = [F.count(F.lit(1)).alias("rows")]
    if name in DATE_COLUMNS:
        day = F.to_date(F.col(DATE_COLUMNS[name]))
        facts.append(F.max(day).alias("newest"))
        if name in MIN_HISTORY_DATES:
            facts.append(F.count_distinct(day).alias("dates"))
    return df.agg(*facts)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Business keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def incomplete_series(
    df: DataFrame, key: str, date_column: str, metric_rows: Mapping[str, int]
) -> DataFrame:
    """Series whose newest date lacks a metric that its history allows.

    Several rows may share the newest date; a metric that one of them has is there,
    so the answer does not depend on their order.
    """
    seen = df.groupBy(key, date_column).agg(
        F.count(F.lit(1)).alias("rows"), *[F.max(F.col(m).isNotNull()).alias(m) for m in metric_rows]
    )
    return lacking_series(seen, key, date_column, metric_rows)


def lacking_series(seen: DataFrame, key: str, date_column: str, metric_rows: Mapping[str, int]) -> DataFrame:
    """As :func:`incomplete_series`, from rows of one or more dates of a series: its
    newest date, the number of ``rows``, and per metric whether that date has it."""
    due = [(F.col("history") >= rows) & ~F.col(f"newest.{metric}") for metric, rows in metric_rows.items()]
    lacking = F.filter(
        F.array(*[F.when(d, m) for d, m in zip(due, metric_rows)]), lambda m: m.isNotNull()
    )
    return (
        seen.groupBy(key)
        .agg(F.sum("rows").alias("history"), F.max(F.struct(date_column, *metric_rows)).alias("newest"))
        .select(key, "history", lacking.alias("lacking"))
        .filter(F.size("lacking") > 0)
    )


def none_of(check: str, subject: str, offenders: DataFrame) -> DataFrame:
    return count_is_zero(check, subject, offenders.agg(F.count(F.lit(1)).alias("n")))


def count_is_zero(check: str, subject: str, counted: DataFrame) -> DataFrame:
    """The check of one row ``n``."""
    return counted.select(F.inline(F.array(_result(check, subject, F.col("n"), 0, F.col("n") == 0))))


def missing_values(name: str, df: DataFrame) -> DataFrame:
    """The check of the columns that are never null."""
    missing = " or ".join(f"{c} is null" for c in NEVER_NULL[name])
    return none_of("missing_metrics", name, df.filter(missing))


def run_checks(tables: Mapping[str, DataFrame], as_of: str | date | None = None) -> DataFrame:
    """``check, subject, value, threshold, passed`` for the tables given."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    parts = [facts_checked(name, table_facts(name, df), today) for name, df in tables.items()]
    for name, keys in BUSINESS_KEYS.items():
        if name in tables:
            parts.append(none_of("duplicate_keys", name, duplicate_keys(tables[name], keys)))
    for name, (key, date_column, metric_rows) in SERIES_METRICS.items():
        if name in tables:
            lacking = incomplete_series(tables[name], key, date_column, metric_rows)
            parts.append(none_of("missing_metrics", name, lacking))
    parts += [missing_values(name, tables[name]) for name in NEVER_NULL if name in tables]
    return reduce(DataFrame.unionAll, parts)


class ValidationError(RuntimeError):
    """A check failed."""


def require_all(results: DataFrame) -> int:
    """Raise on a failed check; return how many passed. One row per check."""
    rows = results.orderBy("check", "subject").collect()
    failed = [f"{r['check']}({r['subject']}) = {r['value']}" for r in rows if not r["passed"]]
    if failed:
        raise ValidationError("Validation failed: " + "; ".join(failed))
    return len(rows)
