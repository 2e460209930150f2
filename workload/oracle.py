"""The same results as plain SQL over the given tables.

Two numeric rules are spelled out, because engines differ on them: a double
becomes a decimal through its shortest text, and rounding is half away from zero
on that decimal.
"""

from __future__ import annotations

import re

from tidegauge.plans.report_states import REPORTS
from tidegauge.sources.schemas import columns_of
from workload.bindings import AS_OF
from workload.managed import HISTORY_RANGE, SPLIT

START, END = HISTORY_RANGE
LOADED_AT = f"'{AS_OF} 06:30:00'"


def _decimal(x: str) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,15))"


def _round(x: str, digits: int) -> str:
    return f"CAST(round({_decimal(x)}, {digits}) AS DOUBLE)"


def _pct(x: str, base: str, digits: int) -> str:
    return _round(f"CASE WHEN {base} <> 0 THEN ({x} - {base}) / {base} * 100 END", digits)


def _avg(x: str, digits: int) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,{digits}))) AS DOUBLE) / count({x})"


def _n(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _text(column: str) -> str:
    return f"CAST({column} AS VARCHAR) AS {column}"


CTES = {
    "market_prices_raw": """
        SELECT symbol, price, currency, market_time, ingested_at,
               CAST(ingested_at AS DATE) AS _ingest_date, _source
        FROM (
            SELECT CAST(l_suppkey AS VARCHAR) || '.US' AS symbol,
                   CASE WHEN l_quantity = 50 THEN NULL
                        WHEN l_linenumber = 7 AND l_discount = 0 THEN level * 1e10
                        ELSE level END AS price,
                   'US' AS currency,
                   l_shipdate AS market_time,
                   l_shipdate + l_linenumber * INTERVAL 1 HOUR AS ingested_at,
                   'feed_' || lower(l_returnflag) AS _source
            FROM (
                SELECT *, 100 + 3 * abs(month(l_shipdate) - 6) + l_extendedprice / 50000 AS level
                FROM lineitem
            )
        )""",
    "fx_rates_raw": """
        SELECT o_orderstatus AS base_currency, o_orderpriority AS quote_currency,
               CASE WHEN o_orderkey % 101 <> 0 THEN 1 + o_totalprice / 1e8
                   + CASE WHEN month(o_orderdate) = 7 THEN CAST(0.01 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
               END AS rate,
               o_orderdate AS rate_timestamp,
               CASE WHEN o_custkey % 5 <> 0 THEN 'feed' END AS source_name,
               o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR AS ingested_at
        FROM orders""",
    "macro_indicators_raw": """
        SELECT n_name AS country_code, o_orderpriority AS indicator_name,
               CASE WHEN o_orderkey % 89 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || 'Q1'
                    ELSE strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d')
               END AS observation_date,
               CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS observation_value,
               '{"order": ' || CAST(o_orderkey AS VARCHAR) || '}' AS raw_payload,
               o_orderdate AS ingest_ts, CAST(o_orderdate AS DATE) AS _ingest_date,
               'orders' AS _source
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "market_prices": f"""
        SELECT * REPLACE (TRY_CAST({_decimal('price')} AS DECIMAL(12,4)) AS price)
        FROM market_prices_raw
        WHERE symbol IS NOT NULL AND market_time IS NOT NULL
          AND TRY_CAST({_decimal('price')} AS DECIMAL(12,4)) IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY symbol, market_time
            ORDER BY ingested_at DESC, price DESC, currency DESC, _source DESC, _ingest_date DESC) = 1""",
    "fx_rates": f"""
        SELECT base_currency || quote_currency AS currency_pair, base_currency, quote_currency,
               TRY_CAST({_decimal('rate')} AS DECIMAL(12,5)) AS rate, rate_timestamp,
               CAST(rate_timestamp AS DATE) AS rate_date,
               coalesce(source_name, 'frankfurter') AS source_system, ingested_at
        FROM fx_rates_raw
        WHERE base_currency IS NOT NULL AND quote_currency IS NOT NULL
          AND rate_timestamp IS NOT NULL AND fx_rates_raw.rate IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY base_currency, quote_currency, rate_timestamp
            ORDER BY ingested_at DESC, TRY_CAST({_decimal('fx_rates_raw.rate')} AS DECIMAL(12,5)) DESC,
                     coalesce(source_name, 'frankfurter') DESC) = 1""",
    "macro_indicators": """
        SELECT * REPLACE (TRY_CAST(observation_date AS DATE) AS observation_date)
        FROM macro_indicators_raw
        WHERE country_code IS NOT NULL AND indicator_name IS NOT NULL
          AND TRY_CAST(observation_date AS DATE) IS NOT NULL AND observation_value IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY country_code, indicator_name, TRY_CAST(observation_date AS DATE)
            ORDER BY ingest_ts DESC, observation_value DESC, raw_payload DESC) = 1""",
    "daily_market_snapshot": f"""
        SELECT symbol, snapshot_date, latest_price, open_price, day_change, day_change_pct,
               return_7d_pct, return_30d_pct, return_90d_pct, rolling_30d_volatility,
               drawdown_from_90d_high_pct,
               coalesce(day_change_pct <= -2 OR return_30d_pct <= -5
                        OR rolling_30d_volatility >= 25 OR drawdown_from_90d_high_pct <= -10,
                        false) AS stress_flag,
               currency, market_time, ingested_at
        FROM (
            SELECT *, {_round('stddev_samp(day_change_pct) OVER (PARTITION BY symbol ORDER BY snapshot_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) * sqrt(252)', 4)} AS rolling_30d_volatility
            FROM (
                SELECT *, p1 AS open_price,
                       {_round('latest_price - p1', 6)} AS day_change,
                       {_pct('latest_price', 'p1', 4)} AS day_change_pct,
                       {_pct('latest_price', 'p7', 4)} AS return_7d_pct,
                       {_pct('latest_price', 'p30', 4)} AS return_30d_pct,
                       {_pct('latest_price', 'p90', 4)} AS return_90d_pct,
                       {_pct('latest_price', 'high', 4)} AS drawdown_from_90d_high_pct
                FROM (
                    SELECT *, lag(latest_price, 1) OVER w AS p1, lag(latest_price, 7) OVER w AS p7,
                           lag(latest_price, 30) OVER w AS p30, lag(latest_price, 90) OVER w AS p90,
                           max(latest_price) OVER (PARTITION BY symbol ORDER BY snapshot_date
                               ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS high
                    FROM (
                        SELECT *, CAST(market_time AS DATE) AS snapshot_date,
                               CAST(price AS DOUBLE) AS latest_price
                        FROM market_prices
                        QUALIFY row_number() OVER (
                            PARTITION BY symbol, CAST(market_time AS DATE)
                            ORDER BY market_time DESC, ingested_at DESC, price DESC) = 1
                    )
                    WINDOW w AS (PARTITION BY symbol ORDER BY snapshot_date)
                )
            )
        )""",
    "fx_trend_signals": f"""
        SELECT currency_pair, rate_date, base_currency, quote_currency, rate, daily_change,
               daily_change_pct, weekly_change_pct, return_30d_pct, rolling_30d_volatility,
               CASE WHEN daily_change_pct >= 0.25 THEN 'strengthening'
                    WHEN daily_change_pct <= -0.25 THEN 'weakening' ELSE 'stable' END AS trend_signal,
               coalesce(abs(daily_change_pct) >= 0.75 OR abs(return_30d_pct) >= 2.5
                        OR rolling_30d_volatility >= 5, false) AS stress_flag,
               ingested_at
        FROM (
            SELECT *, {_round('stddev_samp(daily_change_pct) OVER (PARTITION BY currency_pair ORDER BY rate_date, rate_timestamp ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) * sqrt(252)', 6)} AS rolling_30d_volatility
            FROM (
                SELECT * REPLACE (r AS rate),
                       {_round('r - r1', 8)} AS daily_change,
                       {_pct('r', 'r1', 6)} AS daily_change_pct,
                       {_pct('r', 'r5', 6)} AS weekly_change_pct,
                       {_pct('r', 'r30', 6)} AS return_30d_pct
                FROM (
                    SELECT *, lag(r, 1) OVER w AS r1, lag(r, 5) OVER w AS r5, lag(r, 30) OVER w AS r30
                    FROM (SELECT *, CAST(rate AS DOUBLE) AS r FROM fx_rates)
                    WINDOW w AS (PARTITION BY currency_pair ORDER BY rate_date, rate_timestamp)
                )
            )
        )""",
    "macro_indicator_trends": f"""
        SELECT country_code, indicator_name, observation_date, observation_value,
               {_round('observation_value - v1', 6)} AS period_change,
               {_pct('observation_value', 'v1', 4)} AS period_change_pct,
               {_pct('observation_value', 'v12', 4)} AS year_over_year_pct,
               CASE WHEN {_round('observation_value - v1', 6)} > 0 THEN 'up'
                    WHEN {_round('observation_value - v1', 6)} < 0 THEN 'down'
                    ELSE 'flat' END AS trend_direction,
               ingest_ts AS ingested_at
        FROM (
            SELECT *, lag(observation_value, 1) OVER w AS v1, lag(observation_value, 12) OVER w AS v12
            FROM macro_indicators
            WINDOW w AS (PARTITION BY country_code, indicator_name ORDER BY observation_date)
        )""",
    "market_breadth": f"""
        SELECT snapshot_date AS as_of_date, count(DISTINCT symbol) AS market_symbols_count,
               {_avg('day_change_pct', 4)} AS market_avg_day_change_pct,
               {_avg('return_30d_pct', 4)} AS market_avg_return_30d_pct,
               {_avg('return_90d_pct', 4)} AS market_avg_return_90d_pct,
               {_n('day_change_pct > 0')} AS market_up_symbols,
               {_n('day_change_pct < 0')} AS market_down_symbols,
               {_n('stress_flag')} AS market_stress_symbols
        FROM daily_market_snapshot GROUP BY snapshot_date""",
    "fx_breadth": f"""
        SELECT rate_date AS as_of_date,
               {_n("trend_signal = 'strengthening'")} AS fx_strengthening_pairs,
               {_n("trend_signal = 'weakening'")} AS fx_weakening_pairs,
               {_avg('daily_change_pct', 6)} AS fx_avg_daily_change_pct,
               {_avg('return_30d_pct', 6)} AS fx_avg_return_30d_pct,
               {_n('stress_flag')} AS fx_stress_pairs
        FROM fx_trend_signals GROUP BY rate_date""",
    "spine": """
        SELECT as_of_date FROM market_breadth UNION SELECT as_of_date FROM fx_breadth""",
    "days": """
        SELECT CAST(l_shipdate AS DATE) AS as_of_date FROM lineitem
        UNION SELECT CAST(o_orderdate AS DATE) FROM orders""",
    "top_movers_why": """
        SELECT as_of_date, symbol, latest_price, day_change_pct, return_30d_pct, stress_flag,
               fx_context, macro_context,
               CASE WHEN stress_flag THEN 'Market stress flag is active.'
                    ELSE 'Market stress flag is not active.' END || ' ' ||
               CASE WHEN return_30d_pct <= -5 THEN '30d return indicates material downside pressure.'
                    WHEN return_30d_pct >= 5 THEN '30d return indicates strong positive momentum.'
                    ELSE '30d return is directionally moderate.' END || ' ' ||
               fx_context || ' ' || macro_context AS why_summary
        FROM (
            SELECT *, row_number() OVER (PARTITION BY move > 0 ORDER BY abs(move) DESC, symbol) AS place
            FROM (
                SELECT snapshot_date AS as_of_date, *, coalesce(return_30d_pct, day_change_pct) AS move
                FROM daily_market_snapshot
                WHERE snapshot_date = (SELECT max(snapshot_date) FROM daily_market_snapshot)
            )
            WHERE move <> 0
        ), (
            SELECT 'FX context: ' || count(*) FILTER (WHERE trend_signal = 'strengthening')
                   || ' strengthening, ' || count(*) FILTER (WHERE trend_signal = 'weakening')
                   || ' weakening, ' || count(*) FILTER (WHERE stress_flag)
                   || ' stressed pairs.' AS fx_context
            FROM fx_trend_signals
            WHERE rate_date = (SELECT max(snapshot_date) FROM daily_market_snapshot)
        ), (
            SELECT 'Macro context: ' || count(*) FILTER (WHERE trend_direction = 'up')
                   || ' up indicators, ' || count(*) FILTER (WHERE trend_direction = 'down')
                   || ' down indicators.' AS macro_context
            FROM (
                SELECT * FROM macro_indicator_trends
                WHERE observation_date <= (SELECT max(snapshot_date) FROM daily_market_snapshot)
                QUALIFY row_number() OVER (
                    PARTITION BY country_code, indicator_name ORDER BY observation_date DESC) = 1
            )
        )
        WHERE place <= 5""",
    "audit": """
        SELECT event_type AS pipeline_name,
               CASE WHEN value > 150 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS row_count,
               CAST(ts AS VARCHAR) AS run_timestamp,
               'event ' || CAST(event_id AS VARCHAR) AS message
        FROM events""",
}


def _asof(dates: str) -> str:
    """State of every series as of each date, the plain way."""
    return f"""
        SELECT as_of_date,
               {_n("trend_direction = 'up'")} AS macro_up_indicators,
               {_n("trend_direction = 'down'")} AS macro_down_indicators,
               {_avg('period_change_pct', 4)} AS macro_avg_period_change_pct,
               {_avg('year_over_year_pct', 4)} AS macro_avg_year_over_year_pct
        FROM (
            SELECT * FROM {dates} LEFT JOIN macro_indicator_trends ON observation_date <= as_of_date
            QUALIFY row_number() OVER (
                PARTITION BY as_of_date, country_code, indicator_name
                ORDER BY observation_date DESC) = 1
        )
        GROUP BY as_of_date"""


CTES["macro_asof"] = _asof("spine")
CTES["cross_counts"] = """
    SELECT as_of_date,
           coalesce(market_symbols_count, 0) AS market_symbols_count, market_avg_day_change_pct,
           market_avg_return_30d_pct, market_avg_return_90d_pct,
           coalesce(market_up_symbols, 0) AS market_up_symbols,
           coalesce(market_down_symbols, 0) AS market_down_symbols,
           coalesce(market_stress_symbols, 0) AS market_stress_symbols,
           coalesce(fx_strengthening_pairs, 0) AS fx_strengthening_pairs,
           coalesce(fx_weakening_pairs, 0) AS fx_weakening_pairs,
           fx_avg_daily_change_pct, fx_avg_return_30d_pct,
           coalesce(fx_stress_pairs, 0) AS fx_stress_pairs,
           coalesce(macro_up_indicators, 0) AS macro_up_indicators,
           coalesce(macro_down_indicators, 0) AS macro_down_indicators,
           macro_avg_period_change_pct, macro_avg_year_over_year_pct
    FROM spine LEFT JOIN market_breadth USING (as_of_date)
    LEFT JOIN fx_breadth USING (as_of_date) LEFT JOIN macro_asof USING (as_of_date)"""
CTES["cross_signal_summary"] = """
    SELECT *, CASE
        WHEN market_avg_return_30d_pct <= -5
             AND (fx_weakening_pairs >= fx_strengthening_pairs OR fx_stress_pairs >= 1) THEN 'stress'
        WHEN market_avg_return_30d_pct <= -2 OR market_stress_symbols > 0 OR fx_stress_pairs > 0
             OR macro_down_indicators > macro_up_indicators THEN 'elevated'
        ELSE 'calm' END AS risk_regime
    FROM cross_counts"""
CTES["newest_market"] = """
    SELECT * FROM daily_market_snapshot
    WHERE snapshot_date = (SELECT max(snapshot_date) FROM daily_market_snapshot)"""
CTES["newest_fx"] = """
    SELECT * FROM fx_trend_signals
    WHERE rate_date = (SELECT max(rate_date) FROM fx_trend_signals)"""

KINDS = {
    "snapshot_date": "date",
    "rate_date": "date",
    "observation_date": "date",
    "as_of_date": "date",
    "_ingest_date": "date",
    "latest_date": "date",
    "market_time": "time",
    "ingested_at": "time",
    "rate_timestamp": "time",
    "ingest_ts": "time",
    "price": "double",
}


def _table(name: str, columns: list[str] | None = None, source: str | None = None, **kinds: str) -> str:
    """Columns of a table in plain types."""
    known = KINDS | kinds

    def plain(column: str) -> str:
        kind = known.get(column)
        if kind in ("date", "time"):
            return _text(column)
        return f"CAST({column} AS DOUBLE) AS {column}" if kind == "double" else column

    return f"SELECT {', '.join(plain(c) for c in columns or columns_of(name))} FROM {source or name}"


def _top(sql: str, order: str, rows: int) -> str:
    return f"{sql} ORDER BY {order} LIMIT {rows}"


def _with(sql: str) -> str:
    """Put the tables a query names ahead of it, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(sql)
    parts = [f"{name} AS ({body})" for name, body in CTES.items() if name in needed]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


def _without(table: str, *columns: str) -> list[str]:
    return [c for c in columns_of(table) if c not in columns]


def _market_rows(symbol: str, price: str, currency: str, time: str, source: str, rest: str) -> str:
    return f"""
        SELECT {symbol} AS symbol, {price} AS price, {currency} AS currency,
               CAST({time} AS VARCHAR) AS market_time, {LOADED_AT} AS ingested_at,
               '{AS_OF}' AS _ingest_date, '{source}' AS _source {rest}"""


SUPPLIER = "'s' || CAST(l_suppkey AS VARCHAR) || '.us'"


def _source_sql() -> dict[str, str]:
    part = "'P' || CAST(l_partkey AS VARCHAR) || '.US'"
    shipped = _day("l_shipdate")
    candle_symbol = (
        "CASE WHEN l_suppkey % 2 = 0 THEN 'S' || CAST(l_suppkey AS VARCHAR) || '.US'"
        " ELSE 'S' || CAST(l_suppkey AS VARCHAR) END"
    )
    candle_currency = "CASE WHEN l_suppkey % 2 = 0 THEN 'us' ELSE 'US' END"
    live = "WHERE l_returnflag <> 'N' AND l_linenumber <> 7"
    upper = f"upper({SUPPLIER})"

    def fx_row(day: str, quote: str, rate: str, where: str = "") -> str:
        return f"""
            SELECT o_orderstatus AS base_currency, {quote} AS quote_currency, {rate} AS rate,
                   CAST(CAST(CAST({day} AS DATE) AS TIMESTAMP) AS VARCHAR) AS rate_timestamp,
                   'frankfurter' AS source_name,
                   'orders/' || CAST(o_orderkey AS VARCHAR) AS source_url,
                   {LOADED_AT} AS ingested_at, 'run-1' AS run_id
            FROM orders {where}"""

    null = "CAST(NULL AS DOUBLE)"
    key = "CAST(o_orderkey AS VARCHAR)"
    live_page = "WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0"
    year = "CAST(year(o_orderdate) AS VARCHAR)"
    blank = "o_orderkey % 3 = 0"
    macro_raw = f"""'{{"country":{{"id":"' || o_orderstatus || '","value":"Name"}},"countryiso3code":"'
        || CASE WHEN {blank} THEN '' ELSE o_orderstatus || 'XX' END
        || '","indicator":{{"id":"' || o_orderpriority || '","value":"'
        || CASE WHEN {blank} THEN '' ELSE 'Orders, total' END || '"}},"date":"' || {year}
        || '","value":' || CAST(o_totalprice AS VARCHAR) || '}}'"""
    macro_missing = f"""'{{"country":{{"id":"' || o_orderstatus || '"}},"indicator":{{"id":"'
        || o_orderpriority || '"}},"date":' || {year} || ',"value":null}}'"""

    macro_rows = f"""
        SELECT o_orderkey AS page_key,
               CASE WHEN {blank} THEN o_orderstatus ELSE o_orderstatus || 'XX' END AS country_code,
               CASE WHEN {blank} THEN o_orderpriority ELSE 'Orders, total' END AS indicator_name,
               {year} AS observation_date, o_totalprice AS observation_value,
               {macro_raw} AS raw_payload
        FROM orders {live_page}
        UNION ALL
        SELECT o_orderkey, o_orderstatus, o_orderpriority, {year}, NULL, {macro_missing}
        FROM orders {live_page}"""

    choice = """
        SELECT s_suppkey, 'S' || CAST(s_suppkey AS VARCHAR) || '.L.US' AS symbol,
               's' || CAST(s_suppkey AS VARCHAR) AS stem, coalesce(n, 0) AS n
        FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1)
          ON s_suppkey = l_suppkey"""
    status = """CASE WHEN s_suppkey % 4 <> 3 AND n > 0 THEN 'ok'
                     WHEN s_suppkey % 8 <> 7 THEN 'snapshot_fallback' ELSE 'empty' END"""
    chosen = """CASE WHEN s_suppkey % 4 = 3 OR n = 0 THEN NULL WHEN s_suppkey % 4 = 0 THEN stem || '.l.us'
                     WHEN s_suppkey % 4 = 1 THEN stem || '.l' ELSE stem END"""
    requested_history = f"""
        SELECT l.*, 'S' || CAST(l_suppkey AS VARCHAR) || '.L.US' AS symbol,
               CASE WHEN l_suppkey % 4 = 0 THEN 'S' || CAST(l_suppkey AS VARCHAR) || '.L.US' END AS s
        FROM lineitem l WHERE l_suppkey % 4 <> 3 AND l_suppkey IN (SELECT s_suppkey FROM supplier)
          AND CAST(l_shipdate AS DATE) BETWEEN '{START}' AND '{END}'"""

    not_json, not_csv = "not the JSON object expected", "not the CSV header expected"
    not_page = "Macro page is not a JSON array of metadata and rows."
    return {
        "parsed_price_csv": f"""
            SELECT l_orderkey AS order_key, {part} AS "Symbol", {shipped} AS "Date",
                   CASE WHEN l_linenumber % 2 = 1 THEN '22:00:00' END AS "Time",
                   CAST(1.5 AS DOUBLE) AS "Open", CAST(2.5 AS DOUBLE) AS "High",
                   CAST(0.5 AS DOUBLE) AS "Low", l_extendedprice AS "Close",
                   CAST(l_quantity AS BIGINT) AS "Volume"
            FROM lineitem WHERE l_linenumber <> 7
            UNION ALL
            SELECT l_orderkey, {part}, 'N/D', 'N/D', NULL, NULL, NULL, NULL, NULL
            FROM lineitem WHERE l_linenumber <> 7""",
        "standardized_prices": _market_rows(
            part,
            "l_extendedprice",
            "'US'",
            "l_shipdate + CASE WHEN l_linenumber % 2 = 1 THEN INTERVAL 22 HOUR ELSE INTERVAL 0 HOUR END",
            "stooq_snapshot",
            "FROM lineitem WHERE l_linenumber <> 7",
        ),
        "standardized_price_history": _market_rows(
            upper, "price", "'US'", "CAST(day AS TIMESTAMP)", "stooq_backfill",
            f"""FROM (
                SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, l_extendedprice AS price FROM lineitem
                UNION ALL
                SELECT l_suppkey, CAST(l_shipdate AS DATE) + 1, l_quantity FROM lineitem
            ) WHERE day BETWEEN '{START}' AND '{END}'""",
        ),
        "parsed_candles": _market_rows(
            candle_symbol, "l_extendedprice", candle_currency, "l_shipdate", "finnhub_backfill",
            f"FROM lineitem {live}",
        )
        + " UNION ALL "
        + _market_rows(
            candle_symbol, "l_quantity", candle_currency, "l_shipdate + INTERVAL 1 DAY",
            "finnhub_backfill", f"FROM lineitem {live}",
        ),
        "parsed_quotes": _market_rows(
            upper, "l_extendedprice", "'us'",
            f"CASE WHEN l_linenumber = 3 THEN TIMESTAMP '{AS_OF} 00:00:00' ELSE l_shipdate END",
            "finnhub_snapshot", "FROM lineitem WHERE l_linenumber NOT IN (1, 2)",
        ),
        "standardized_bars": _market_rows(
            upper, "l_extendedprice", "'us'", "l_shipdate", "yfinance_backfill", "FROM lineitem"
        ),
        "latest_bars": _market_rows(
            upper, "l_extendedprice", "'us'", "l_shipdate", "yfinance_snapshot",
            """FROM (
                SELECT * FROM lineitem
                WHERE CAST(l_shipdate AS DATE) BETWEEN '2001-06-26' AND '2001-06-30'
                QUALIFY row_number() OVER (
                    PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_extendedprice DESC) = 1
            )""",
        ),
        "parsed_fx_latest": fx_row(
            "o_orderdate", "o_orderpriority", "o_totalprice", "WHERE o_orderkey % 11 <> 0"
        )
        + " UNION ALL "
        + fx_row("o_orderdate", "'NUL'", null, "WHERE o_orderkey % 11 <> 0"),
        "parsed_fx_range": " UNION ALL ".join(
            [
                fx_row("o_orderdate", "o_orderpriority", "o_totalprice"),
                fx_row("o_orderdate", "'NUL'", null),
                fx_row("o_orderdate + INTERVAL 1 DAY", "o_orderpriority", "CAST(o_orderkey AS DOUBLE)"),
            ]
        ),
        "parsed_macro_pages": macro_rows,
        "standardized_indicators": f"""
            SELECT * EXCLUDE (page_key), {LOADED_AT} AS ingest_ts, '{AS_OF}' AS _ingest_date,
                   'https://api.worldbank.org/v2/country/all/indicator' AS _source
            FROM ({macro_rows})""",
        "macro_page_counts": """
            SELECT o_orderkey AS page_key,
                   CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN 1
                        ELSE CAST(o_orderkey % 7 + 1 AS INTEGER) END AS page_count
            FROM orders""",
        "rejected_payloads": " UNION ALL ".join(
            f"""SELECT '{feed}' AS feed, reason, count(*) AS payloads, CAST(sum(key) AS BIGINT) AS key_sum
                FROM (SELECT {key} AS key, CASE WHEN {key} % 20 = 2 THEN '{odd}'
                             ELSE '{other}' END AS reason
                      FROM {rows} WHERE {key} % 20 < 4) GROUP BY reason"""
            for feed, rows, key, odd, other in (
                ("candles", "lineitem", "l_partkey", "prices and times differ in number", not_json),
                ("quotes", "lineitem", "l_partkey", not_json, not_json),
                ("fx_latest", "orders", "o_custkey", "a date that is none", not_json),
                ("fx_range", "orders", "o_custkey", "a date that is none", not_json),
                ("price_csv", "lineitem", "l_partkey", not_csv, not_csv),
                ("price_history_csv", "lineitem", "l_partkey", not_csv, not_csv),
                ("macro_pages", "orders", "o_custkey", not_page, not_page),
            )
        ),
        "vendor_tickers": """
            SELECT part_key, symbol,
                   CASE symbol WHEN 'VIX.US' THEN '^VIX' WHEN 'DXY.US' THEN 'DX-Y.NYB'
                               ELSE upper(split_part(symbol, '.', 1)) END AS ticker,
                   CASE WHEN contains(symbol, '.') THEN split_part(symbol, '.', 2) ELSE 'US' END AS currency,
                   CASE WHEN contains(symbol, '.')
                        THEN lower(symbol) || ',' || lower(split_part(symbol, '.', 1))
                        ELSE symbol END AS variants
            FROM (
                SELECT p_partkey AS part_key,
                       CASE p_partkey % 10 WHEN 0 THEN 'VIX.US' WHEN 1 THEN 'DXY.US' WHEN 2 THEN 'spot'
                            ELSE 'p' || CAST(p_partkey AS VARCHAR) || '.us' END AS symbol
                FROM part
            )""",
        "first_available_source": _market_rows(
            "symbol", "l_extendedprice", "'L'", "l_shipdate", "stooq_backfill",
            f"FROM ({requested_history})",
        )
        + f"""
            UNION ALL
            SELECT symbol, s_acctbal, 'L', '{AS_OF} 00:00:00', {LOADED_AT}, '{AS_OF}',
                   'stooq_backfill_snapshot_fallback'
            FROM ({choice}) JOIN supplier USING (s_suppkey)
            WHERE {status} = 'snapshot_fallback'""",
        "load_report": f"""
            SELECT symbol, status, source_symbol, rows,
                   symbol || '=' || status || '[' ||
                   CASE WHEN status = 'empty' THEN stem || '.l.us:0,' || stem || '.l:0,' || stem || ':0'
                        ELSE source_symbol || ';rows=' || CAST(rows AS VARCHAR) END || ']' AS token
            FROM (
                SELECT symbol, stem, {status} AS status,
                       CASE WHEN {status} = 'snapshot_fallback' THEN lower(symbol) ELSE {chosen} END
                           AS source_symbol,
                       CASE {status} WHEN 'ok' THEN n WHEN 'empty' THEN 0 ELSE 1 END AS rows
                FROM ({choice})
            )""",
        "load_report_counts": """
            SELECT status, count(*) AS symbols, CAST(sum(rows) AS BIGINT) AS rows
            FROM (
                SELECT CASE WHEN key % 3 < 2 AND n > 0 THEN 'ok'
                            WHEN key % 2 = 0 THEN 'snapshot_fallback' ELSE 'empty' END AS status,
                       CASE WHEN key % 3 < 2 AND n > 0 THEN n WHEN key % 2 = 0 THEN 1 ELSE 0 END AS rows
                FROM (
                    SELECT n_nationkey AS key, count(c_custkey) AS n
                    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey
                )
            ) GROUP BY status""",
    }


def _build_sql() -> dict[str, str]:
    movers = _table("top_movers_why")
    return {
        "bronze_market_prices": _table("market_prices_raw"),
        "bronze_enriched_events": f"""
            SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props,
                   {LOADED_AT} AS _ingest_timestamp, '{AS_OF}' AS _ingest_date,
                   'events_feed' AS _source, 'run-1' AS _run_id
            FROM events""",
        "silver_market_prices": _table("market_prices"),
        "silver_fx_rates": _table("fx_rates", rate="double"),
        "silver_macro_indicators": _table("macro_indicators"),
        "gold_market_snapshot": _table("daily_market_snapshot"),
        "gold_fx_trends": _table("fx_trend_signals"),
        "gold_macro_trends": _table("macro_indicator_trends"),
        "gold_macro_trends_legacy": f"""
            SELECT country_code, indicator_name, {_text('observation_date')}, observation_value, raw_payload,
                   {_text('ingest_ts')}, {_text('_ingest_date')}, _source, prev_value,
                   observation_value - prev_value AS change_value,
                   {_round('CASE WHEN prev_value <> 0 THEN (observation_value - prev_value) / prev_value * 100 END', 4)} AS change_pct,
                   CASE WHEN observation_value - prev_value > 0 THEN 'increase'
                        WHEN observation_value - prev_value < 0 THEN 'decrease'
                        ELSE 'flat' END AS trend_direction
            FROM (
                SELECT *, lag(observation_value) OVER (
                    PARTITION BY country_code, indicator_name ORDER BY observation_date) AS prev_value
                FROM macro_indicators
            )""",
        "gold_cross_signal_summary": _table("cross_signal_summary"),
        "gold_top_movers_why": movers,
        "market_breadth_by_date": "SELECT * REPLACE (CAST(as_of_date AS VARCHAR) AS as_of_date) FROM market_breadth",
        "fx_breadth_by_date": "SELECT * REPLACE (CAST(as_of_date AS VARCHAR) AS as_of_date) FROM fx_breadth",
        "macro_asof_by_date": f"SELECT * REPLACE (CAST(as_of_date AS VARCHAR) AS as_of_date) FROM ({_asof('days')})",
        "latest_market_rows": _table("daily_market_snapshot", source="newest_market"),
        "duplicate_raw_prices": f"""
            SELECT symbol, {_text('market_time')}, count(*) AS copies FROM market_prices_raw
            GROUP BY symbol, market_prices_raw.market_time HAVING count(*) > 1""",
        "short_series": f"""
            SELECT symbol, history, concat_ws(',',
                       CASE WHEN history < 91 THEN 'return_90d_pct' END,
                       CASE WHEN history < 31 THEN 'return_30d_pct' END,
                       CASE WHEN history < 8 THEN 'return_7d_pct' END) AS lacking
            FROM (
                SELECT CAST(l_partkey AS VARCHAR) || '.US' AS symbol,
                       count(DISTINCT CAST(l_shipdate AS DATE)) AS history
                FROM lineitem
                WHERE l_quantity <> 50 AND NOT (l_linenumber = 7 AND l_discount = 0)
                GROUP BY l_partkey
            )
            WHERE history < 91""",
    }


def _checks_sql() -> str:
    parts = []

    def result(check: str, subject: str, value: str, limit: int, op: str, source: str) -> None:
        parts.append(
            f"SELECT '{check}' AS \"check\", '{subject}' AS subject, CAST({value} AS BIGINT) AS value,"
            f" CAST({limit} AS BIGINT) AS threshold, coalesce({value} {op} {limit}, false) AS passed"
            f" FROM {source}"
        )

    tables = [
        "market_prices_raw", "fx_rates_raw", "macro_indicators_raw",
        "market_prices", "fx_rates", "macro_indicators",
        "daily_market_snapshot", "fx_trend_signals", "macro_indicator_trends",
        "cross_signal_summary", "top_movers_why",
    ]
    for name in tables:
        result("non_empty", name, "count(*)", 0, ">", name)
    ages = {
        "market_prices": ("CAST(market_time AS DATE)", 10, 90),
        "fx_rates": ("rate_date", 10, 30),
        "macro_indicators": ("observation_date", 1200, 8),
        "cross_signal_summary": ("as_of_date", 10, None),
    }
    for name, (day, age, depth) in ages.items():
        value = f"date_diff('day', max({day}), DATE '{AS_OF}')"
        result("freshness_days", name, value, age, "<=", name)
        if depth:
            result("history_dates", name, f"count(DISTINCT {day})", depth, ">=", name)
    keys = {
        "market_prices": "symbol, market_time",
        "fx_rates": "base_currency, quote_currency, rate_timestamp",
        "macro_indicators": "country_code, indicator_name, observation_date",
    }
    for name, key in keys.items():
        copies = f"(SELECT 1 FROM {name} GROUP BY {key} HAVING count(*) > 1)"
        result("duplicate_keys", name, "count(*)", 0, "=", copies)

    def newest(name: str, key: str, day: str) -> str:
        return f"""(
            SELECT *, count(*) OVER (PARTITION BY {key}) AS history FROM {name}
            QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {day} DESC) = 1)"""

    result(
        "missing_metrics", "daily_market_snapshot", "count(*)", 0, "=",
        newest("daily_market_snapshot", "symbol", "snapshot_date")
        + """ WHERE (history >= 8 AND return_7d_pct IS NULL) OR (history >= 31 AND return_30d_pct IS NULL)
              OR (history >= 91 AND return_90d_pct IS NULL)
              OR (history >= 31 AND rolling_30d_volatility IS NULL)
              OR drawdown_from_90d_high_pct IS NULL""",
    )
    result(
        "missing_metrics", "fx_trend_signals", "count(*)", 0, "=",
        newest("fx_trend_signals", "currency_pair", "rate_date")
        + """ WHERE history >= 31 AND (return_30d_pct IS NULL OR rolling_30d_volatility IS NULL
              OR trend_signal IS NULL OR stress_flag IS NULL)""",
    )
    result("missing_metrics", "cross_signal_summary", "count(*)", 0, "=",
           "cross_signal_summary WHERE risk_regime IS NULL")
    result("missing_metrics", "top_movers_why", "count(*)", 0, "=",
           "top_movers_why WHERE why_summary IS NULL OR fx_context IS NULL OR macro_context IS NULL")
    return " UNION ALL ".join(parts)


def _coverage(table: str, day: str, names: tuple[str, str], **distinct: str) -> str:
    counts = "".join(f", count(DISTINCT {c}) AS {n}" for n, c in distinct.items())
    return f"""
        SELECT CAST(min({day}) AS VARCHAR) AS {names[0]}, CAST(max({day}) AS VARCHAR) AS {names[1]},
               count(*) AS total_rows {counts}
        FROM {table}"""


def _report_sql() -> dict[str, str]:
    fx_columns = [
        "currency_pair", "rate_date", "rate", "daily_change_pct", "weekly_change_pct",
        "return_30d_pct", "rolling_30d_volatility", "trend_signal", "stress_flag",
    ]
    macro_columns = [
        "country_code", "indicator_name", "observation_date", "observation_value",
        "period_change_pct", "year_over_year_pct", "trend_direction",
    ]
    stress_columns = [
        "symbol", "snapshot_date", "latest_price", "day_change_pct", "return_30d_pct",
        "return_90d_pct", "rolling_30d_volatility", "drawdown_from_90d_high_pct", "stress_flag",
        "currency",
    ]
    audit_columns = ["pipeline_name", "status", "row_count", "run_timestamp", "message"]
    sql = {
        "briefing_latest_dates": """
            SELECT CAST((SELECT max(as_of_date) FROM cross_signal_summary) AS VARCHAR) AS regime_as_of_date,
                   CAST((SELECT max(snapshot_date) FROM daily_market_snapshot) AS VARCHAR) AS market_snapshot_date,
                   CAST((SELECT max(rate_date) FROM fx_trend_signals) AS VARCHAR) AS fx_rate_date,
                   CAST((SELECT max(as_of_date) FROM top_movers_why) AS VARCHAR) AS movers_as_of_date""",
        "briefing_regime": _top(
            _table(
                "cross_signal_summary",
                _without("cross_signal_summary", "market_symbols_count", "market_avg_return_90d_pct"),
            ),
            "cross_signal_summary.as_of_date DESC", 1,
        ),
        "briefing_top_movers": _top(
            _table("top_movers_why"), "return_30d_pct ASC NULLS FIRST, symbol", 10
        ),
        "briefing_market_breadth": f"""
            SELECT {_text('snapshot_date')}, count(*) AS symbols_in_snapshot,
                   {_n('day_change_pct > 0')} AS advancing_symbols,
                   {_n('day_change_pct < 0')} AS declining_symbols,
                   {_n('stress_flag')} AS stressed_symbols,
                   {_round(_avg('day_change_pct', 4), 4)} AS avg_day_change_pct,
                   {_round(_avg('return_30d_pct', 4), 4)} AS avg_return_30d_pct,
                   {_round(_avg('return_90d_pct', 4), 4)} AS avg_return_90d_pct,
                   {_round(_avg('rolling_30d_volatility', 4), 4)} AS avg_rolling_30d_volatility
            FROM newest_market GROUP BY newest_market.snapshot_date""",
        "briefing_market_stress": _top(
            _table("daily_market_snapshot", stress_columns, "newest_market"),
            "stress_flag DESC NULLS LAST, drawdown_from_90d_high_pct ASC NULLS FIRST,"
            " rolling_30d_volatility DESC NULLS LAST, symbol", 10,
        ),
        "briefing_fx_watchlist": _top(
            _table("fx_trend_signals", fx_columns, "newest_fx"),
            "stress_flag DESC NULLS LAST, abs(return_30d_pct) DESC NULLS LAST,"
            " rolling_30d_volatility DESC NULLS LAST, currency_pair", 10,
        ),
        "briefing_macro_trends": _top(
            _table("macro_indicator_trends", macro_columns)
            + """ WHERE macro_indicator_trends.observation_date =
                  (SELECT max(observation_date) FROM macro_indicator_trends)""",
            "country_code, indicator_name", 15,
        ),
        "briefing_market_coverage": _coverage(
            "daily_market_snapshot", "snapshot_date", ("first_snapshot_date", "latest_snapshot_date"),
            distinct_symbols="symbol", distinct_snapshot_dates="snapshot_date",
            distinct_currencies="currency",
        ),
        "briefing_fx_coverage": _coverage(
            "fx_trend_signals", "rate_date", ("first_rate_date", "latest_rate_date"),
            distinct_currency_pairs="currency_pair", distinct_rate_dates="rate_date",
        ),
        "briefing_fx_history_summary": f"""
            SELECT currency_pair, first_rate_date, latest_rate_date, observations,
                   {_round('daily', 4)} AS avg_abs_daily_change_pct,
                   {_round('vol', 4)} AS avg_rolling_30d_volatility,
                   {_round('peak', 4)} AS max_abs_return_30d_pct
            FROM (
                SELECT currency_pair, CAST(min(rate_date) AS VARCHAR) AS first_rate_date,
                       CAST(max(rate_date) AS VARCHAR) AS latest_rate_date, count(*) AS observations,
                       {_avg('abs(daily_change_pct)', 6)} AS daily,
                       {_avg('rolling_30d_volatility', 6)} AS vol, max(abs(return_30d_pct)) AS peak
                FROM fx_trend_signals GROUP BY currency_pair
                ORDER BY observations DESC, vol DESC NULLS LAST, currency_pair LIMIT 10
            )""",
        "briefing_macro_coverage": _coverage(
            "macro_indicator_trends", "observation_date",
            ("first_observation_date", "latest_observation_date"),
            distinct_countries="country_code", distinct_indicators="indicator_name",
            distinct_observation_dates="observation_date",
        ),
        "dashboard_kpis": _table(
            "cross_signal_summary",
            ["as_of_date", "risk_regime", "market_stress_symbols", "fx_stress_pairs",
             "macro_up_indicators", "macro_down_indicators"],
        )
        + """ WHERE cross_signal_summary.as_of_date = (SELECT max(as_of_date) FROM cross_signal_summary)""",
        "dashboard_trend": _top(
            _table(
                "cross_signal_summary",
                ["as_of_date", "market_avg_return_30d_pct", "fx_stress_pairs", "macro_up_indicators",
                 "macro_down_indicators", "risk_regime"],
            ),
            "cross_signal_summary.as_of_date DESC", 30,
        ),
        "dashboard_movers": _top(
            _table("top_movers_why"),
            "top_movers_why.as_of_date DESC, return_30d_pct ASC NULLS FIRST, symbol", 20,
        ),
        "dashboard_audit_health": f"""
            SELECT {', '.join(audit_columns)} FROM audit
            QUALIFY row_number() OVER (PARTITION BY pipeline_name ORDER BY run_timestamp DESC, message DESC) = 1""",
        "dashboard_audit_failures": f"""
            SELECT {', '.join(audit_columns)} FROM audit WHERE status = 'FAILED'
            ORDER BY run_timestamp DESC, pipeline_name, message LIMIT 20""",
        "demo_layer_counts": " UNION ALL ".join(
            f"SELECT '{label}' AS layer_name, count(*) AS row_count FROM {table}"
            for label, table in {
                "bronze_market": "market_prices_raw", "silver_market": "market_prices",
                "gold_market_snapshot": "daily_market_snapshot", "bronze_fx": "fx_rates_raw",
                "silver_fx": "fx_rates", "gold_fx_trends": "fx_trend_signals",
                "bronze_macro": "macro_indicators_raw", "silver_macro": "macro_indicators",
                "gold_macro_trends": "macro_indicator_trends",
                "gold_cross_signal_summary": "cross_signal_summary",
            }.items()
        ),
        "demo_freshness": " UNION ALL ".join(
            f"SELECT '{label}' AS dataset, CAST(max({day}) AS VARCHAR) AS latest_date FROM {table}"
            for label, table, day in (
                ("market", "market_prices", "CAST(market_time AS DATE)"),
                ("fx", "fx_rates", "rate_date"),
                ("macro", "macro_indicators", "observation_date"),
                ("cross_signal_summary", "cross_signal_summary", "as_of_date"),
            )
        ),
        "demo_history_depth": """
            SELECT (SELECT count(DISTINCT CAST(market_time AS DATE)) FROM market_prices) AS market_history_days,
                   (SELECT count(DISTINCT rate_date) FROM fx_rates) AS fx_history_days,
                   (SELECT count(DISTINCT observation_date) FROM macro_indicators) AS macro_history_periods""",
        "demo_recent_regimes": _top(
            _table("cross_signal_summary"), "cross_signal_summary.as_of_date DESC", 10
        ),
        "demo_stressed_instruments": _top(
            _table(
                "daily_market_snapshot",
                ["symbol", "snapshot_date", "latest_price", "return_30d_pct", "return_90d_pct",
                 "rolling_30d_volatility", "drawdown_from_90d_high_pct", "stress_flag"],
                "newest_market",
            ),
            "stress_flag DESC NULLS LAST, drawdown_from_90d_high_pct ASC NULLS FIRST,"
            " return_30d_pct ASC NULLS FIRST, symbol", 10,
        ),
        "demo_fx_signals": _top(
            _table("fx_trend_signals", fx_columns, "newest_fx"),
            "stress_flag DESC NULLS LAST, abs(return_30d_pct) DESC NULLS LAST,"
            " abs(daily_change_pct) DESC NULLS LAST, currency_pair", 10,
        ),
        "demo_recent_macro": _top(
            _table("macro_indicator_trends", macro_columns),
            "macro_indicator_trends.observation_date DESC, country_code, indicator_name", 15,
        ),
        "demo_recent_movers": _top(
            _table(
                "daily_market_snapshot",
                ["symbol", "snapshot_date", "return_30d_pct", "return_90d_pct", "rolling_30d_volatility"],
                "newest_market",
            ),
            "return_30d_pct ASC NULLS FIRST, return_90d_pct ASC NULLS FIRST, symbol", 10,
        ),
        "validation_checks": _checks_sql(),
        "measure_headlines": """
            SELECT risk_regime AS current_regime, market_stress_symbols AS stressed_instruments,
                   CASE WHEN market_symbols_count > 0
                        THEN market_up_symbols / market_symbols_count END AS market_breadth_pct,
                   fx_stress_pairs AS fx_stressed_pairs
            FROM cross_signal_summary
            WHERE as_of_date = (SELECT max(as_of_date) FROM cross_signal_summary)""",
        "measure_stress_count": f"""
            SELECT symbol, {_n('stress_flag')} AS stress_count FROM daily_market_snapshot GROUP BY symbol""",
        "measure_drawdown_labels": f"""
            SELECT symbol, {_text('snapshot_date')}, drawdown_from_90d_high_pct,
                   CASE WHEN drawdown_from_90d_high_pct <= -20 THEN 'Severe'
                        WHEN drawdown_from_90d_high_pct <= -10 THEN 'Moderate'
                        WHEN drawdown_from_90d_high_pct <= -5 THEN 'Mild'
                        ELSE 'Near High' END AS drawdown_label
            FROM daily_market_snapshot""",
        "measure_macro_consensus": f"""
            SELECT *, CASE WHEN up_indicators > 1.5 * down_indicators THEN 'Expanding'
                           WHEN down_indicators > 1.5 * up_indicators THEN 'Contracting'
                           ELSE 'Mixed' END AS macro_consensus
            FROM (
                SELECT {_n("trend_direction = 'up'")} AS up_indicators,
                       {_n("trend_direction = 'down'")} AS down_indicators
                FROM macro_indicator_trends
                WHERE observation_date = (SELECT max(observation_date) FROM macro_indicator_trends)
            )""",
        "measure_mover_directions": f"""
            SELECT {_text('as_of_date')}, symbol,
                   CASE WHEN coalesce(return_30d_pct, 0) >= 0 THEN 'Up' ELSE 'Down' END AS mover_direction,
                   abs(return_30d_pct) AS abs_return_30d
            FROM top_movers_why""",
        "report_risk_return_by_symbol": f"""
            SELECT symbol, {_avg('return_30d_pct', 4)} AS avg_return_30d_pct,
                   {_avg('rolling_30d_volatility', 4)} AS avg_rolling_30d_volatility,
                   abs({_avg('drawdown_from_90d_high_pct', 4)}) AS abs_drawdown_pct
            FROM daily_market_snapshot GROUP BY symbol""",
        "report_rate_by_date_and_pair": f"""
            SELECT {_text('rate_date')}, currency_pair, {_avg('rate', 5)} AS avg_rate
            FROM fx_trend_signals GROUP BY fx_trend_signals.rate_date, currency_pair""",
        "report_stressed_pairs_card": "SELECT count(stress_flag) AS stressed_pairs FROM fx_trend_signals",
        "report_yoy_by_indicator_and_trend": f"""
            SELECT indicator_name, trend_direction, {_avg('year_over_year_pct', 4)} AS avg_year_over_year_pct
            FROM macro_indicator_trends GROUP BY indicator_name, trend_direction""",
        "report_value_by_date_and_indicator": f"""
            SELECT {_text('observation_date')}, indicator_name,
                   {_avg('observation_value', 2)} AS avg_observation_value
            FROM macro_indicator_trends
            GROUP BY macro_indicator_trends.observation_date, indicator_name""",
        "report_movers_by_symbol_and_flag": f"""
            SELECT symbol, stress_flag, {_avg('return_30d_pct', 4)} AS avg_return_30d_pct
            FROM top_movers_why GROUP BY symbol, stress_flag""",
    }
    details = {
        "daily_market_snapshot": "snapshot_date",
        "fx_trend_signals": "rate_date",
        "top_movers_why": "as_of_date",
    }
    for table in (*details, "cross_signal_summary", "macro_indicator_trends"):
        sql[f"view_{table}"] = _table(table, _without(table, "ingested_at"))
    for table, day in details.items():
        joined = f"""(
            SELECT d.*, s.risk_regime, s.market_avg_return_30d_pct
            FROM {table} d LEFT JOIN cross_signal_summary s ON d.{day} = s.as_of_date)"""
        sql[f"spine_{table}"] = _table(
            table, [*columns_of(table), "risk_regime", "market_avg_return_30d_pct"], joined
        )
    for table, day in (details | {"cross_signal_summary": "as_of_date"}).items():
        sql[f"export_{table}"] = (
            _table(table) + f" WHERE {table}.{day} >= DATE '{AS_OF}' - INTERVAL 365 DAY"
        )
    return sql


def _briefing_sql(reports: dict[str, str]) -> str:
    """All sections, row by row and field by field."""
    parts = []
    for name, sql in reports.items():
        if name.startswith("briefing_"):
            # The sections come sorted and limited; their order is kept.
            parts.append(
                f"""SELECT '{name.removeprefix("briefing_")}' AS section, place, field.key AS field, field.atom AS value
                    FROM (SELECT row_number() OVER () - 1 AS place, to_json(r) AS body FROM ({sql}) r) s,
                         json_each(s.body) AS field"""
            )
    return f"""
        SELECT section, place, field, number, CASE WHEN number IS NULL THEN value END AS text
        FROM (
            SELECT section, place, field, trim(CAST(value AS VARCHAR), '"') AS value,
                   TRY_CAST(trim(CAST(value AS VARCHAR), '"') AS DOUBLE) AS number
            FROM ({" UNION ALL ".join(parts)})
        )"""


def _long_series_sql() -> dict[str, str]:
    """Frame and decimals as in the queries."""
    levels = (("month", "strftime(snapshot_date, '%Y-%m')"), ("year", "strftime(snapshot_date, '%Y')"), ("all", "'all'"))
    return {
        "asof_indicator_rows": """
            SELECT currency_pair, quote_currency, CAST(rate_timestamp AS VARCHAR) AS rate_timestamp,
                   CAST(rate AS DOUBLE) AS rate, CAST(o.told.observation_date AS VARCHAR) AS observation_date,
                   o.told.country_code AS country_code, o.told.observation_value AS observation_value,
                   o.told.trend_direction AS trend_direction
            FROM fx_rates
            ASOF LEFT JOIN (
                SELECT indicator_name, CAST(observation_date AS TIMESTAMP) AS told_at,
                       arg_max({'observation_date': observation_date, 'country_code': country_code,
                                'observation_value': observation_value, 'trend_direction': trend_direction},
                               country_code) AS told
                FROM macro_indicator_trends GROUP BY 1, 2
            ) o ON fx_rates.quote_currency = o.indicator_name AND fx_rates.rate_timestamp >= o.told_at""",
        "fx_long_frames": """
            SELECT currency_pair, CAST(rate_timestamp AS VARCHAR) AS rate_timestamp, CAST(rate AS DOUBLE) AS rate,
                   n AS rates_in_frame, high / 1e5 AS high, low / 1e5 AS low,
                   CAST(s AS DOUBLE) / n / 1e5 AS mean,
                   CASE WHEN n > 1
                        THEN sqrt(CAST(n * q - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) / 1e5
                   END AS deviation
            FROM (
                SELECT *, count(u) OVER w AS n, sum(u) OVER w AS s, sum(CAST(u AS HUGEINT) * u) OVER w AS q,
                       max(u) OVER w AS high, min(u) OVER w AS low
                FROM (SELECT *, CAST(round(rate * 100000) AS BIGINT) AS u FROM fx_rates)
                WINDOW w AS (PARTITION BY currency_pair
                             ORDER BY rate_date, rate_timestamp, base_currency, quote_currency
                             ROWS BETWEEN 499 PRECEDING AND CURRENT ROW)
            )""",
        "history_coverage": " UNION ALL ".join(
            f"SELECT '{name}' AS level, {period} AS period, count(DISTINCT symbol) AS series,"
            f" count(DISTINCT snapshot_date) AS days FROM daily_market_snapshot GROUP BY 2"
            for name, period in levels
        ),
    }


def _managed_sql() -> dict[str, str]:
    exported = [
        f"CAST({c} AS VARCHAR) || '.678901' AS {c}" if c == "ingested_at" else _text(c) if c == "rate_date" else f"fx_trend_signals.{c}"
        for c in columns_of("fx_trend_signals")
    ]
    loads = "(SELECT count(*) FROM orders)"
    silver = "(SELECT count(*) FROM fx_rates)"
    runs = [
        ("bronze_fx_rates_raw", "SUCCESS", loads, 2), ("silver_fx_rates", "SUCCESS", silver, 1),
        ("gold_fx_trend_signals", "SUCCESS", silver, 1), ("bronze_fx_rates_raw", "SUCCESS", "0", 1),
        ("bronze_macro_indicators_raw", "FAILED", "0", 1), ("validation_queries", "FAILED", "0", 1),
    ]
    return {
        "managed_rates": _table("fx_rates", rate="double"),
        "managed_runs": " UNION ALL ".join(
            f"SELECT '{name}' AS pipeline_name, '{status}' AS status, CAST({rows} AS BIGINT) AS row_count,"
            f" CAST({times} AS BIGINT) AS runs"
            for name, status, rows, times in runs
        ),
        "booked_rates": _table(
            "fx_rates_raw",
            ["base_currency", "quote_currency", "rate", "rate_timestamp", "source_name", "ingested_at"],
        ),
        "versioned_rates": " UNION ALL ".join(
            f"SELECT currency_pair, count(*) AS rates, CAST(max(rate_timestamp) AS VARCHAR) AS newest,"
            f" '{version}' AS version FROM fx_rates WHERE {rows} GROUP BY currency_pair"
            for version, rows in (("before", f"rate_timestamp < TIMESTAMP '{SPLIT}'"), ("after", "true"))
        ),
        "backfilled_prices": _source_sql()["first_available_source"],
        "incremental_market_snapshot": _table("daily_market_snapshot"),
        "incremental_fx_trends": _table("fx_trend_signals"),
        "incremental_macro_trends": _table("macro_indicator_trends"),
        "incremental_cross_signal_summary": _table("cross_signal_summary"),
        "incremental_top_movers_why": _table("top_movers_why"),
        "exported_signals": f"""
            SELECT {", ".join(exported)}, n AS parquet_rows FROM fx_trend_signals
            JOIN (SELECT currency_pair, count(*) AS n FROM fx_trend_signals GROUP BY 1) USING (currency_pair)
            WHERE fx_trend_signals.rate_date >= DATE '{AS_OF}' - INTERVAL 365 DAY""",
    }


def all_sql() -> dict[str, str]:
    reports = _report_sql()
    reports["briefing_json"] = _briefing_sql(reports)
    # What comes from states is checked by the SQL over the daily rows.
    from_states = {f"state_{name}": reports[name] for name in (*REPORTS, "validation_checks", "briefing_json")}
    for name, column, raw in (("demo_layer_counts", "layer_name", "bronze%"), ("validation_checks", "subject", "%raw")):
        from_states[f"state_{name}"] = f"SELECT * FROM ({reports[name]}) WHERE {column} NOT LIKE '{raw}'"
    parts = (_build_sql(), _source_sql(), reports, _long_series_sql(), _managed_sql(), from_states)
    return {name: _with(sql) for part in parts for name, sql in part.items()}
