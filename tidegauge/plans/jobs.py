"""The daily jobs: scan tables, build, write, audit."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidegauge.plans import report_states
from tidegauge.plans.checks import require_all, run_checks
from tidegauge.plans.cross import cross_signal_summary
from tidegauge.plans.fx import fx_trends
from tidegauge.plans.macro import macro_trends
from tidegauge.plans.market import by_symbol, market_closes, market_snapshot, snapshot_of
from tidegauge.plans.movers import top_movers_why
from tidegauge.plans.silver import clean_fx, clean_macro, clean_market
from tidegauge.sinks.audit import audited, log_run, try_log_run, write_counted
from tidegauge.sinks.export import EXPORTS, export_json, export_parquet
from tidegauge.sinks.loads import booked_parts, load, rows_of
from tidegauge.sinks.tables import gathered, require_rows, shuffles_freed
from tidegauge.sinks.versions import current_version, read_version, replace
from tidegauge.sources.payloads import rejected
from tidegauge.sources.prices import first_available_source, load_report, report_counts
from tidegauge.sources.schemas import TABLES, columns_of
from tidegauge.sources.tables import Catalog, scan

# Target table -> tables it is built from and the function that builds it.
SILVER: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "market_prices": (("market_prices_raw",), clean_market),
    "fx_rates": (("fx_rates_raw",), clean_fx),
    "macro_indicators": (("macro_indicators_raw",), clean_macro),
}
GOLD: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "daily_market_snapshot": (("market_prices",), market_snapshot),
    "fx_trend_signals": (("fx_rates",), fx_trends),
    "macro_indicator_trends": (("macro_indicators",), macro_trends),
    "cross_signal_summary": (
        ("daily_market_snapshot", "fx_trend_signals", "macro_indicator_trends"),
        cross_signal_summary,
    ),
    "top_movers_why": (
        ("daily_market_snapshot", "fx_trend_signals", "macro_indicator_trends"),
        top_movers_why,
    ),
}
# Builder -> what its windows find, and its rows from that, each from one row alone: the
# former goes to the months, since it takes fewer bytes in a shuffle.
STEPS: dict[Callable[..., DataFrame], tuple[Callable[..., DataFrame], Callable[[DataFrame], DataFrame]]] = {
    market_snapshot: (market_closes, snapshot_of),
}
# Builder -> how its input is dealt ahead of a build of the whole table.
DEALT: dict[Callable[..., DataFrame], Callable[[DataFrame], DataFrame]] = {market_snapshot: by_symbol}


def rows_by_month(
    table: str, build: Callable[..., DataFrame], *inputs: DataFrame, only: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The rows that a builder makes, gathered by month; ``only`` picks those to be written."""
    windows, rows = STEPS.get(build, (build, None))
    found = windows(*inputs)
    dealt = gathered(only(found) if only else found, table)
    return rows(dealt) if rows else dealt


#: Symbols named in the message of a load that found nothing.
EXPLAINED = 20


def ingest(
    rows: DataFrame,
    table: str,
    keep_history: bool = False,
    note: str = "",
    explain: Callable[[], str] | None = None,
    load_id: str | None = None,
    prefix: str = "",
) -> int:
    """Append parsed payloads to a raw table, each load id once.

    ``note`` goes into the audit message, say what was asked for or how many
    payloads were rejected; ``explain`` says why, where nothing was loaded.
    """
    spark = rows.sparkSession
    name = f"bronze_{table}"
    try:
        done = load(rows, table, load_id, prefix)
        if done.repeated:
            message = f"{table}: load {load_id} was there already"
        else:
            message = require_rows(spark, done.rows, table, keep_history, explain, prefix)
        message += f"; {note}" if note else ""
    except Exception as error:
        try_log_run(spark, name, "FAILED", 0, str(error), prefix)
        raise
    try_log_run(spark, name, "SUCCESS", done.rows, message, prefix)
    return done.rows


def ingest_landed(
    payloads: DataFrame,
    feed: str,
    table: str,
    parse: Callable[..., DataFrame],
    keep_history: bool = False,
    prefix: str = "",
    **options,
) -> int:
    """Parse and append a feed's landed payloads; broken ones are left out and counted
    in the audit message."""
    bad = rejected(payloads, feed).count()
    rows = parse(payloads, on_bad="skip", **options)
    return ingest(rows, table, keep_history, f"{bad} payloads rejected", prefix=prefix)


def backfill(
    requested: DataFrame,
    history: DataFrame,
    snapshots: DataFrame,
    start: str | date,
    end: str | date,
    prefix: str = "",
    **options,
) -> int:
    """Load the best source per symbol; says what was tried if there is none."""

    def explain() -> str:
        tokens = load_report(requested, history, snapshots).orderBy("symbol").limit(EXPLAINED).collect()
        return "tried " + "; ".join(r["token"] for r in tokens)

    rows = first_available_source(requested, history, snapshots, start, end, **options)
    counts = report_counts(load_report(requested, history, snapshots)).orderBy("status").collect()
    symbols = ", ".join(f"{r['symbols']} {r['status']}" for r in counts)
    return ingest(rows, "market_prices_raw", note=f"symbols: {symbols}; {start} to {end}", explain=explain, prefix=prefix)


def rebuild(spark: SparkSession, layer: str, targets, prefix: str = "") -> int:
    """Rebuild the tables given, each with an audit row; returns their rows."""
    with shuffles_freed(spark):
        return _rebuild(spark, layer, targets, prefix)


def _rebuild(spark: SparkSession, layer: str, targets, prefix: str) -> int:
    total = 0
    for table, (inputs, build) in targets.items():

        def run(table=table, inputs=inputs, build=build) -> int:
            parts, source = [], None
            if layer == "silver":
                # The very loads that the version's book names.
                (raw,) = inputs
                parts = booked_parts(spark, raw, prefix)
                read = [rows_of(spark, raw, parts, prefix)]
            elif len(inputs) == 1:
                (name,) = inputs
                source = current_version(spark, name, prefix)
                whole = read_version(spark, name, source, prefix).select(*columns_of(name))
                read = [DEALT[build](whole) if build in DEALT else whole]
            else:
                read = [scan(spark, name, prefix) for name in inputs]
            rows = rows_by_month(table, build, *read)
            book = {"loads": parts, "source": source, "prefix": prefix, "by_month": True}
            return write_counted(lambda seen: replace(rows, table, seen, **book))

        total += audited(spark, f"{layer}_{table}", run, prefix)
    return total


def rebuild_silver(spark: SparkSession, prefix: str = "") -> int:
    return rebuild(spark, "silver", SILVER, prefix)


def rebuild_gold(spark: SparkSession, prefix: str = "") -> int:
    return audited(spark, "gold_analytics", lambda: rebuild(spark, "gold", GOLD, prefix), prefix)


def validate(spark: SparkSession, as_of: str | date | None = None, prefix: str = "", from_states: bool = False) -> int:
    """Check all tables; the audit row is part of the result, so it may fail.

    ``from_states`` reads the states that updates keep instead of the tables.
    """
    tables = {name: scan(spark, name, prefix) for name in TABLES if name != "pipeline_runs"}
    try:
        results = report_states.run_checks(Catalog(spark, prefix), as_of) if from_states else run_checks(tables, as_of)
        passed = require_all(results)
    except Exception as error:
        try_log_run(spark, "validation_queries", "FAILED", 0, str(error), prefix)
        raise
    log_run(spark, "validation_queries", "SUCCESS", len(tables), f"{passed} checks passed", prefix)
    return passed


def export_gold(spark: SparkSession, folder: str, today: str | date | None = None, prefix: str = "") -> None:
    for table, date_column in EXPORTS.items():
        df = scan(spark, table, prefix)
        export_parquet(df, f"{folder}/{table}")
        if date_column:
            export_json(df, f"{folder}/dashboard/{table}", date_column, today)
