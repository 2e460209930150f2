"""States of months add up to what the reports return over all rows."""

from __future__ import annotations

import pytest

from helpers import day, rows
from tidegauge.plans import briefing, checks, measures, report_states
from tidegauge.sources.schemas import TABLES
from tidegauge.sources.tables import empty

INF, NAN = float("inf"), float("nan")


def market(spark, data):
    """(symbol, day, return_7d, return_30d, volatility, drawdown, stress, currency)."""
    rows_ = [(s, d, 1.0, 1.0, 0.0, 0.0, r7, r30, None, v, dd, st, c, None, None) for s, d, r7, r30, v, dd, st, c in data]
    return spark.createDataFrame(rows_, TABLES["daily_market_snapshot"][1])


def by_month(df, table):
    """The state as it is kept: built month by month."""
    state = report_states.STATE_OF[table]
    build = report_states.BUILDERS[state][1]
    column = report_states.MONTH_OF[table]
    months = [r[0] for r in df.selectExpr(f"date_format({column}, 'yyyy-MM')").distinct().collect()]
    parts = [build(df.filter(f"date_format({column}, 'yyyy-MM') <=> {m!r}" if m else f"{column} IS NULL")) for m in months]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return {state: whole, table: df}


DATA = [
    ("a", day(0), 0.1, 0.2, None, -5.0, True, "US"),
    ("a", day(0), 0.1, 0.2, None, -5.0, True, "US"),
    ("a", day(31), None, 0.1, INF, None, False, "DE"),
    ("a", day(32), None, None, 1.0, -1.0, None, None),
    ("b", day(31), 0.3, NAN, 2.0, -2.0, True, "US"),
    ("b", day(70), 1e307, 1e307, 1e307, -2.0, True, ""),
    ("b", day(70), None, 1e307, None, None, None, "US"),
    (None, day(70), None, None, None, None, None, None),
]


def test_market_states_add_up(spark):
    tables = by_month(market(spark, DATA), "daily_market_snapshot")
    gold = {"daily_market_snapshot": tables["daily_market_snapshot"]}
    expected = briefing.market_coverage(gold)
    assert rows(report_states.market_coverage(tables), *expected.columns) == rows(expected)
    by_symbol = gold["daily_market_snapshot"].groupBy("symbol")
    means = [
        measures.exact_avg(report_states.F.col(m), 4).alias(a)
        for m, a in (("return_30d_pct", "avg_return_30d_pct"), ("rolling_30d_volatility", "avg_rolling_30d_volatility"))
    ]
    got = report_states.risk_return_by_symbol(tables).drop("abs_drawdown_pct")
    assert [str(r) for r in rows(got)] == [str(r) for r in rows(by_symbol.agg(*means))]
    stressed = measures.stress_count(gold["daily_market_snapshot"], "symbol")
    assert rows(report_states.stress_count(tables)) == rows(stressed)


@pytest.mark.parametrize("limit", [1, 3, 4])
def test_newest_date_is_found_across_months(spark, limit):
    tables = by_month(market(spark, DATA), "daily_market_snapshot")
    limits = {"return_7d_pct": limit, "return_30d_pct": limit, "drawdown_from_90d_high_pct": 1}
    expected = checks.incomplete_series(tables["daily_market_snapshot"], "symbol", "snapshot_date", limits)
    states = tables["market_report_months"]
    seen = states.selectExpr("symbol", "last_date", "row_count AS rows", *[f"has_{m} AS {m}" for m in limits])
    assert rows(checks.lacking_series(seen, "symbol", "last_date", limits)) == rows(expected)


def test_duplicates_rows_and_days_of_silver(spark):
    stamp = "2024-01-{:02} 10:00:00"
    keys = [("a", stamp.format(3)), ("a", stamp.format(3)), ("b", stamp.format(3)), ("b", "2024-02-03 00:00:00")]
    keys += [("c", "2024-02-29 23:59:59")] * 3
    data = spark.createDataFrame(keys, "symbol string, at string").selectExpr(
        "symbol", "CAST(1 AS decimal(12,4)) price", "'US' currency", "CAST(at AS timestamp) market_time",
        "CAST(at AS timestamp) ingested_at", "CAST(at AS date) _ingest_date", "'x' _source",
    )
    tables = by_month(data, "market_prices")
    fact = report_states.facts(tables, "market_prices").first()
    assert (fact["rows"], str(fact["newest"]), fact["dates"]) == (7, "2024-02-29", 3)
    state = tables["market_prices_months"].agg({"duplicate_keys": "sum"}).first()[0]
    assert state == checks.duplicate_keys(data, checks.MARKET_KEY).count() == 2


def test_reports_of_empty_tables(spark):
    tables = {name: empty(spark, name) for name in (*TABLES, *report_states.BUILDERS, "load_ledger")}
    for name, section in report_states.HEAVY_SECTIONS.items():
        expected = briefing.HEAVY_SECTIONS[name](tables)
        assert rows(section(tables), *expected.columns) == rows(expected), name
    assert rows(report_states.stressed_pairs_card(tables)) == [(0,)]
    named = {name: tables[name] for name in TABLES if name != "pipeline_runs"}
    assert rows(report_states.run_checks(tables, day(0))) == rows(checks.run_checks(named, day(0)))
