"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.symbols import history_variants, map_ticker, suffix_or_us
from tidegauge.operators.asof_rows import asof_rows
from tidegauge.operators.latest import latest_rows
from tidegauge.operators.long_frames import deviation_of_state, mean_of_state, moving_state
from tidegauge.plans import briefing, checks, coverage, cross, dashboards, macro, measures, report_states
from tidegauge.plans.market import market_snapshot
from tidegauge.plans.silver import MARKET_KEY, typed_prices
from tidegauge.session import configure
from tidegauge.sinks.export import EXPORTS, json_ready, recent
from tidegauge.sinks.tables import enrich
from tidegauge.sources import indicators, prices, rates
from tidegauge.sources.payloads import ALL_FEEDS, rejected
from tidegauge.sources.schemas import PRICE_HISTORY_CSV, PRICE_SNAPSHOT_CSV, columns_of
from tidegauge.sources.tables import Catalog
from workload import bindings, managed, payloads
from workload.bindings import AS_OF
from workload.lake import Lake
from workload.payloads import loaded_at

Query = Callable[[SparkSession, str], DataFrame]

HISTORY_RANGE = managed.HISTORY_RANGE


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as texts, decimals as doubles, lists as joined texts."""

    def plain(name: str, kind: str):
        if kind == "date" or kind.startswith("timestamp"):
            return F.col(name).cast("string")
        if kind.startswith("decimal"):
            return F.col(name).cast("double")
        if kind == "array<string>":
            return F.array_join(name, ",")
        return F.col(name)

    return df.select(*[plain(name, kind).alias(name) for name, kind in df.dtypes])


def _query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(build(configure(spark), sf_dir))

    return run


def _builds() -> dict[str, Query]:
    """Silver and Gold tables, each from the raw rows on."""
    names = {
        "market_prices": "silver_market_prices",
        "fx_rates": "silver_fx_rates",
        "macro_indicators": "silver_macro_indicators",
        "daily_market_snapshot": "gold_market_snapshot",
        "fx_trend_signals": "gold_fx_trends",
        "macro_indicator_trends": "gold_macro_trends",
        "cross_signal_summary": "gold_cross_signal_summary",
        "top_movers_why": "gold_top_movers_why",
    }
    def build(table: str) -> Query:
        return lambda s, d: Lake(s, d)[table]

    return {name: build(table) for table, name in names.items()} | {
        "gold_macro_trends_legacy": lambda s, d: macro.macro_trends_legacy(
            Lake(s, d)["macro_indicators"]
        ),
        "bronze_market_prices": bindings.raw_prices,
        "bronze_enriched_events": lambda s, d: enrich(
            bindings.table(s, d, "events"), "events_feed", "run-1", loaded_at()
        ),
    }


def _primitives() -> dict[str, Query]:
    def asof(s: SparkSession, d: str) -> DataFrame:
        # Every day an order or a shipment falls on, macro data or not.
        days = [
            bindings.table(s, d, name).select(F.to_date(column).alias("as_of_date"))
            for name, column in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"))
        ]
        dates = days[0].unionByName(days[1]).dropDuplicates(["as_of_date"])
        return cross.macro_asof_summary(dates, Lake(s, d)["macro_indicator_trends"])

    return {
        "market_breadth_by_date": lambda s, d: cross.market_breadth_by_date(
            Lake(s, d)["daily_market_snapshot"]
        ),
        "fx_breadth_by_date": lambda s, d: cross.fx_breadth_by_date(Lake(s, d)["fx_trend_signals"]),
        "macro_asof_by_date": asof,
        "latest_market_rows": lambda s, d: latest_rows(
            Lake(s, d)["daily_market_snapshot"], "snapshot_date"
        ),
        "duplicate_raw_prices": lambda s, d: checks.duplicate_keys(
            bindings.raw_prices(s, d), MARKET_KEY
        ),
        # Parts ship less often than suppliers; asked of every series, whatever its
        # history, so that the short ones show up.
        "short_series": lambda s, d: checks.incomplete_series(
            market_snapshot(typed_prices(bindings.raw_prices(s, d, "l_partkey"))),
            "symbol",
            "snapshot_date",
            {"return_90d_pct": 1, "return_30d_pct": 1, "return_7d_pct": 1},
        ),
    }


def _sources() -> dict[str, Query]:
    def standardized(s: SparkSession, d: str) -> DataFrame:
        rows = prices.parse_price_csv(payloads.price_csv(s, d), PRICE_SNAPSHOT_CSV)
        return prices.standardize_prices(rows, "stooq_snapshot", loaded_at())

    def history(s: SparkSession, d: str) -> DataFrame:
        rows = prices.parse_price_csv(payloads.history_csv(s, d), PRICE_HISTORY_CSV)
        return prices.standardize_price_history(rows, *HISTORY_RANGE, "stooq_backfill", loaded_at())

    def landed(s: SparkSession, d: str):
        return (
            payloads.requested_symbols(s, d),
            payloads.landed_history(s, d),
            payloads.landed_snapshots(s, d),
        )

    def nation_counts(s: SparkSession, d: str) -> DataFrame:
        report = prices.load_report(
            payloads.nation_request(s, d), payloads.nation_history(s, d), payloads.nation_snapshots(s, d)
        )
        return prices.report_counts(report)

    def rejects(s: SparkSession, d: str) -> DataFrame:
        found = None
        for feed in ALL_FEEDS:
            rows = rejected(payloads.broken(s, d, feed), feed)
            part = rows.groupBy(F.lit(feed).alias("feed"), "reason").agg(
                F.count(F.lit(1)).alias("payloads"), F.sum("landed_key").alias("key_sum")
            )
            found = part if found is None else found.unionByName(part)
        return found

    def tickers(s: SparkSession, d: str) -> DataFrame:
        symbol = F.col("symbol")
        return payloads.vendor_symbols(s, d).select(
            "part_key",
            "symbol",
            map_ticker(symbol).alias("ticker"),
            suffix_or_us(symbol).alias("currency"),
            history_variants(symbol).alias("variants"),
        )

    return {
        "parsed_price_csv": lambda s, d: prices.parse_price_csv(
            payloads.price_csv(s, d), PRICE_SNAPSHOT_CSV
        ),
        "standardized_prices": standardized,
        "standardized_price_history": history,
        "parsed_candles": lambda s, d: prices.parse_candles(
            payloads.candles(s, d), ingested_at=loaded_at()
        ),
        "parsed_quotes": lambda s, d: prices.parse_quotes(
            payloads.quotes(s, d), ingested_at=loaded_at()
        ),
        "standardized_bars": lambda s, d: prices.standardize_bars(
            payloads.bars(s, d), ingested_at=loaded_at()
        ),
        "latest_bars": lambda s, d: prices.latest_bar(
            payloads.bars(s, d), "2001-06-30", ingested_at=loaded_at()
        ),
        "parsed_fx_latest": lambda s, d: rates.parse_fx_latest(
            payloads.fx_latest(s, d), "run-1", loaded_at()
        ),
        "parsed_fx_range": lambda s, d: rates.parse_fx_range(
            payloads.fx_range(s, d), "run-1", loaded_at()
        ),
        "parsed_macro_pages": lambda s, d: indicators.parse_macro_pages(payloads.macro_pages(s, d)),
        "standardized_indicators": lambda s, d: indicators.standardize_indicators(
            indicators.parse_macro_pages(payloads.macro_pages(s, d)), ingested_at=loaded_at()
        ),
        "macro_page_counts": lambda s, d: indicators.page_counts(payloads.macro_pages(s, d)),
        "rejected_payloads": rejects,
        "vendor_tickers": tickers,
        "first_available_source": lambda s, d: prices.first_available_source(
            *landed(s, d), *HISTORY_RANGE, ingested_at=loaded_at()
        ),
        "load_report": lambda s, d: prices.load_report(*landed(s, d)),
        "load_report_counts": nation_counts,
    }


def _reports() -> dict[str, Query]:
    """Readers of the Silver and Gold tables that the daily jobs write."""

    def over_tables(build: Callable[[Catalog], DataFrame]) -> Query:
        return lambda s, d: build(managed.tables(s, d))

    def over_audit(build: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda s, d: build(bindings.audit_runs(s, d))

    queries = {
        f"briefing_{name}": over_tables(build)
        for name, build in (briefing.SECTIONS | briefing.HEAVY_SECTIONS).items()
    }
    queries["briefing_json"] = over_tables(
        lambda t: briefing.briefing_fields(briefing.briefing_json(t, include_heavy=True))
    )
    queries |= {
        "dashboard_kpis": over_tables(dashboards.kpis),
        "dashboard_trend": over_tables(dashboards.trend),
        "dashboard_movers": over_tables(dashboards.movers),
        "dashboard_audit_health": over_audit(dashboards.audit_health),
        "dashboard_audit_failures": over_audit(dashboards.audit_failures),
        "demo_layer_counts": over_tables(dashboards.layer_counts),
        "demo_freshness": over_tables(dashboards.freshness),
        "demo_history_depth": over_tables(dashboards.history_depth),
        "demo_recent_regimes": over_tables(dashboards.recent_regimes),
        "demo_stressed_instruments": over_tables(dashboards.stressed_instruments),
        "demo_fx_signals": over_tables(dashboards.fx_signals),
        "demo_recent_macro": over_tables(dashboards.recent_macro),
        "demo_recent_movers": over_tables(dashboards.recent_movers),
        "validation_checks": over_tables(
            lambda t: checks.run_checks({name: t[name] for name in t if name != "pipeline_runs"}, AS_OF)
        ),
        "measure_headlines": over_tables(
            lambda t: measures.headline_measures(t["cross_signal_summary"])
        ),
        "measure_stress_count": over_tables(
            lambda t: measures.stress_count(t["daily_market_snapshot"], "symbol")
        ),
        "measure_drawdown_labels": over_tables(
            lambda t: measures.drawdown_labels(t["daily_market_snapshot"])
        ),
        "measure_macro_consensus": over_tables(
            lambda t: measures.macro_consensus(t["macro_indicator_trends"])
        ),
        "measure_mover_directions": over_tables(
            lambda t: measures.mover_directions(t["top_movers_why"])
        ),
    }
    report_names = (
        "risk_return_by_symbol",
        "rate_by_date_and_pair",
        "stressed_pairs_card",
        "yoy_by_indicator_and_trend",
        "value_by_date_and_indicator",
        "movers_by_symbol_and_flag",
    )
    queries |= {
        f"report_{name}": over_tables(lambda t, name=name: measures.report_avgs(t)[name])
        for name in report_names
    }
    queries |= {
        f"view_{table}": over_tables(lambda t, table=table: measures.bi_view(t, table))
        for table in measures.VIEW_OMITS
    }
    queries |= {
        f"spine_{table}": over_tables(lambda t, table=table: measures.date_spine_view(t, table))
        for table in measures.SPINE_DATES
    }
    queries |= {
        f"export_{table}": over_tables(
            lambda t, table=table, day=day: json_ready(recent(t[table].select(*columns_of(table)), day, AS_OF))
        )
        for table, day in EXPORTS.items()
        if day
    }
    return queries


#: Rates in a long frame and in a block, and decimals of a rate.
LONG_FRAME, LONG_BLOCK, RATE_DIGITS = 500, 128, 5


def _long_series() -> dict[str, Query]:
    """Operators for series longer than a task should hold, over the written tables."""

    def indicators_as_of(s: SparkSession, d: str) -> DataFrame:
        written = managed.tables(s, d)
        observed = written["macro_indicator_trends"].select(
            F.col("indicator_name").alias("quote_currency"),
            "observation_date", "country_code", "observation_value", "trend_direction",
        )
        rates = written["fx_rates"].select("currency_pair", "quote_currency", "rate_timestamp", "rate")
        return asof_rows(rates, observed, ["quote_currency"], "rate_timestamp", "observation_date", ["country_code"])

    def long_frames(s: SparkSession, d: str) -> DataFrame:
        framed = moving_state(
            managed.tables(s, d)["fx_rates"],
            ["currency_pair"],
            ["rate_date", "rate_timestamp", "base_currency", "quote_currency"],
            F.date_trunc("hour", "rate_timestamp"),
            F.date_trunc("second", "rate_timestamp"),
            F.col("rate"),
            RATE_DIGITS,
            LONG_FRAME,
            LONG_BLOCK,
        )
        unit = float(10**RATE_DIGITS)
        return framed.select(
            "currency_pair", "rate_timestamp", "rate", F.col("frame_n").alias("rates_in_frame"),
            (F.col("frame_high") / unit).alias("high"), (F.col("frame_low") / unit).alias("low"),
            mean_of_state(RATE_DIGITS).alias("mean"),
            deviation_of_state(RATE_DIGITS).alias("deviation"),
        )

    return {
        "asof_indicator_rows": indicators_as_of,
        "fx_long_frames": long_frames,
        "history_coverage": lambda s, d: coverage.coverage_report(
            coverage.coverage_states(managed.tables(s, d)["daily_market_snapshot"], "symbol", "snapshot_date")
        ),
    }


def _managed() -> dict[str, Query]:
    """The jobs and sinks, over tables of their own in the session's warehouse."""
    updated = {
        "incremental_market_snapshot": "daily_market_snapshot",
        "incremental_fx_trends": "fx_trend_signals",
        "incremental_macro_trends": "macro_indicator_trends",
        "incremental_cross_signal_summary": "cross_signal_summary",
        "incremental_top_movers_why": "top_movers_why",
    }
    return {
        "managed_rates": managed.managed_rates,
        "managed_runs": managed.managed_runs,
        "exported_signals": managed.exported_signals,
        "booked_rates": managed.booked_rates,
        "versioned_rates": managed.versioned_rates,
        "backfilled_prices": managed.backfilled_prices,
        **{name: managed.updated(table) for name, table in updated.items()},
        **{f"state_{name}": managed.from_states(build) for name, build in report_states.REPORTS.items()},
        # Raw rows of that lake come in part twice, by a hash that SQL does not have; their
        # counts are left to the tests.
        "state_demo_layer_counts": managed.from_states(
            lambda t: report_states.layer_counts(t).filter("layer_name NOT LIKE 'bronze%'")
        ),
        "state_validation_checks": managed.from_states(
            lambda t: report_states.run_checks(t, AS_OF).filter("subject NOT LIKE '%raw'")
        ),
        "state_briefing_json": managed.from_states(
            lambda t: briefing.briefing_fields(
                briefing.briefing_json(t, include_heavy=True, heavy=report_states.HEAVY_SECTIONS)
            )
        ),
    }


def all_queries() -> dict[str, Query]:
    queries = _builds() | _primitives() | _sources() | _reports() | _long_series() | _managed()
    return {name: _query(build) for name, build in queries.items()}
