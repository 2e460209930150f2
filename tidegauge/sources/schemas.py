"""Table names, column contracts and payload schemas."""

from __future__ import annotations

# Table name -> (layer, columns in contract order).
TABLES = {
    "market_prices_raw": (
        "bronze",
        "symbol string, price double, currency string, market_time timestamp,"
        " ingested_at timestamp, _ingest_date date, _source string",
    ),
    "fx_rates_raw": (
        "bronze",
        "base_currency string not null, quote_currency string not null, rate double,"
        " rate_timestamp timestamp, source_name string, source_url string,"
        " ingested_at timestamp not null, run_id string not null",
    ),
    "macro_indicators_raw": (
        "bronze",
        "country_code string, indicator_name string, observation_date string,"
        " observation_value double, raw_payload string, ingest_ts timestamp,"
        " _ingest_date date, _source string",
    ),
    "market_prices": (
        "silver",
        "symbol string, price decimal(12,4), currency string, market_time timestamp,"
        " ingested_at timestamp, _ingest_date date, _source string",
    ),
    "fx_rates": (
        "silver",
        "currency_pair string, base_currency string, quote_currency string,"
        " rate decimal(12,5), rate_timestamp timestamp, rate_date date,"
        " source_system string, ingested_at timestamp",
    ),
    "macro_indicators": (
        "silver",
        "country_code string, indicator_name string, observation_date date,"
        " observation_value double, raw_payload string, ingest_ts timestamp,"
        " _ingest_date date, _source string",
    ),
    "daily_market_snapshot": (
        "gold",
        "symbol string, snapshot_date date, latest_price double, open_price double,"
        " day_change double, day_change_pct double, return_7d_pct double,"
        " return_30d_pct double, return_90d_pct double, rolling_30d_volatility double,"
        " drawdown_from_90d_high_pct double, stress_flag boolean, currency string,"
        " market_time timestamp, ingested_at timestamp",
    ),
    "fx_trend_signals": (
        "gold",
        "currency_pair string, rate_date date, base_currency string, quote_currency string,"
        " rate double, daily_change double, daily_change_pct double, weekly_change_pct double,"
        " return_30d_pct double, rolling_30d_volatility double, trend_signal string,"
        " stress_flag boolean, ingested_at timestamp",
    ),
    "macro_indicator_trends": (
        "gold",
        "country_code string, indicator_name string, observation_date date,"
        " observation_value double, period_change double, period_change_pct double,"
        " year_over_year_pct double, trend_direction string, ingested_at timestamp",
    ),
    "cross_signal_summary": (
        "gold",
        "as_of_date date, market_symbols_count bigint, market_avg_day_change_pct double,"
        " market_avg_return_30d_pct double, market_avg_return_90d_pct double,"
        " market_up_symbols bigint, market_down_symbols bigint, market_stress_symbols bigint,"
        " fx_strengthening_pairs bigint, fx_weakening_pairs bigint,"
        " fx_avg_daily_change_pct double, fx_avg_return_30d_pct double, fx_stress_pairs bigint,"
        " macro_up_indicators bigint, macro_down_indicators bigint,"
        " macro_avg_period_change_pct double, macro_avg_year_over_year_pct double,"
        " risk_regime string",
    ),
    "top_movers_why": (
        "gold",
        "as_of_date date, symbol string, latest_price double, day_change_pct double,"
        " return_30d_pct double, stress_flag boolean, fx_context string,"
        " macro_context string, why_summary string",
    ),
    "pipeline_runs": (
        "audit",
        "pipeline_name string, status string, row_count bigint, message string,"
        " run_timestamp timestamp",
    ),
}

# What the jobs keep beside the contract: states that Gold is rebuilt from where little
# changed, and books of loads and versions.
STATES = {
    "market_series_months": ("state", "symbol string, month string, observations bigint"),
    "fx_series_months": ("state", "currency_pair string, month string, observations bigint"),
    "macro_series_months": (
        "state",
        "country_code string, indicator_name string, month string, observations bigint",
    ),
    "market_breadth": (
        "state",
        "as_of_date date, market_symbols_count bigint, market_avg_day_change_pct double,"
        " market_avg_return_30d_pct double, market_avg_return_90d_pct double,"
        " market_up_symbols bigint, market_down_symbols bigint, market_stress_symbols bigint",
    ),
    "fx_breadth": (
        "state",
        "as_of_date date, fx_strengthening_pairs bigint, fx_weakening_pairs bigint,"
        " fx_avg_daily_change_pct double, fx_avg_return_30d_pct double, fx_stress_pairs bigint",
    ),
    "macro_changes": (
        "state",
        "as_of_date date, macro_up_indicators bigint, macro_down_indicators bigint, "
        + ", ".join(
            f"{name}__n bigint, {name}__sum decimal(38,4), {name}__nan bigint, {name}__up bigint, {name}__down bigint"
            for name in ("macro_avg_period_change_pct", "macro_avg_year_over_year_pct")
        ),
    ),
}


def _silver_months() -> tuple[str, str]:
    return "state", "month string, row_count bigint, newest date, days int, duplicate_keys bigint"


def _mean(name: str) -> str:
    return f"{name}__n bigint, {name}__whole double, {name}__rest double, {name}__large double"


# States of the reports and checks: one row per month (and series), which add up. ``days``
# has a bit for each day of the month that occurs; ``has_`` says of the last date only.
REPORT_STATES = {
    "market_prices_months": _silver_months(),
    "fx_rates_months": _silver_months(),
    "macro_indicators_months": _silver_months(),
    "market_report_months": (
        "state",
        "month string, symbol string, first_date date, last_date date, row_count bigint, days int,"
        " stressed bigint, currencies array<string>, has_return_7d_pct boolean, has_return_30d_pct boolean,"
        " has_return_90d_pct boolean, has_rolling_30d_volatility boolean, has_drawdown_from_90d_high_pct boolean, "
        + ", ".join(_mean(m) for m in ("return_30d_pct", "rolling_30d_volatility", "drawdown_from_90d_high_pct")),
    ),
    "fx_report_months": (
        "state",
        "month string, currency_pair string, first_date date, last_date date, row_count bigint, days int,"
        " flagged bigint, max_abs_return_30d_pct double, has_return_30d_pct boolean,"
        " has_rolling_30d_volatility boolean, has_trend_signal boolean, has_stress_flag boolean, "
        + ", ".join(_mean(m) for m in ("abs_daily_change_pct", "rolling_30d_volatility")),
    ),
    "macro_report_months": (
        "state",
        "month string, country_code string, indicator_name string, trend_direction string,"
        " first_date date, last_date date, row_count bigint, days int, " + _mean("year_over_year_pct"),
    ),
}
STATES |= REPORT_STATES
BOOKS = {
    "load_ledger": (
        "audit",
        "table_name string, load_id string, part string, row_count bigint, content decimal(38,0),"
        " loaded_at timestamp",
    ),
    "table_versions": (
        "audit",
        "table_name string, version bigint, kind string, part string, folder string, written_at timestamp",
    ),
}
ALL_TABLES = TABLES | STATES | BOOKS

# How tables lie on disk: raw rows by load, in order of the day they came in, Silver,
# Gold and states by the month of their date. Load and month are extra columns that
# the contract does not show.
LOAD = "_load"
INGEST_DAY = {"market_prices_raw": "_ingest_date", "macro_indicators_raw": "_ingest_date"}
MONTH = "_month"
MONTH_OF = {
    "market_prices": "market_time",
    "fx_rates": "rate_date",
    "macro_indicators": "observation_date",
    "daily_market_snapshot": "snapshot_date",
    "fx_trend_signals": "rate_date",
    "macro_indicator_trends": "observation_date",
    "cross_signal_summary": "as_of_date",
    "top_movers_why": "as_of_date",
    "market_series_months": "month",
    "fx_series_months": "month",
    "macro_series_months": "month",
    "market_breadth": "as_of_date",
    "fx_breadth": "as_of_date",
    "macro_changes": "as_of_date",
    **dict.fromkeys(REPORT_STATES, "month"),
}

LAYERS = ("bronze", "silver", "gold", "audit", "state")


def qualified(table: str, prefix: str = "") -> str:
    """The table's name; a prefix gives a set of tables schemas of its own."""
    return f"{prefix}{ALL_TABLES[table][0]}.{table}"


def columns_of(table: str) -> list[str]:
    return [column.split()[0] for column in ALL_TABLES[table][1].split(", ")]


# Payload layouts of the price, FX and macro feeds.
PRICE_SNAPSHOT_CSV = (
    "Symbol string, Date string, Time string, Open double, High double, Low double,"
    " Close double, Volume bigint"
)
PRICE_HISTORY_CSV = (
    "Date string, Open double, High double, Low double, Close double, Volume bigint"
)
CANDLES_JSON = "s string, c array<double>, t array<bigint>"
QUOTE_JSON = "c double, t bigint"
FX_LATEST_JSON = "base string, date string, rates map<string,double>"
FX_RANGE_JSON = "base string, rates map<string,map<string,double>>"
MACRO_META_JSON = "pages int"
MACRO_ROW_JSON = (
    "countryiso3code string, country struct<id:string,value:string>,"
    " indicator struct<id:string,value:string>, date string, value string"
)
