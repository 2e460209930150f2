"""Landed price payloads to market rows.

Each parser takes a frame of payloads, one per row, and parses all of them in
one job. The result columns are those of ``market_prices_raw``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.symbols import history_variants, second_part, suffix_or_us
from tidegauge.operators.latest import dedupe_latest
from tidegauge.sources.payloads import read, read_csv
from tidegauge.sources.schemas import columns_of

MARKET_COLUMNS = columns_of("market_prices_raw")

# Fixed value: what the CSV feed writes for a missing field.
NOT_QUOTED = "N/D"


def _stamped(df: DataFrame, source: str | Column, ingested_at: Column | None) -> DataFrame:
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    source = F.lit(source) if isinstance(source, str) else source
    return df.withColumns(
        {"ingested_at": stamp, "_ingest_date": F.to_date(stamp), "_source": source}
    ).select(*MARKET_COLUMNS)


def _midnight(day: Column) -> Column:
    return F.to_date(day).cast("timestamp")


def parse_price_csv(
    payloads: DataFrame, schema: str, text: str = "payload", on_bad: str = "raise"
) -> DataFrame:
    """CSV texts to typed rows, next to the other columns of their payload.

    Blank lines are dropped, the first line left is the header, which must name the
    columns of ``schema``: a text with another one, say an error page, fails the parse
    or, with ``on_bad="skip"``, is left out. A number that does not parse (``N/D``)
    becomes null.
    """
    others = [c for c in payloads.columns if c != text]
    fields = [column.split() for column in schema.split(", ")]
    as_text = ", ".join(f"{name} string" for name, _ in fields)

    def typed(name: str, kind: str) -> Column:
        field = F.col(f"_row.{name}")
        if kind != "string":
            # The feed's placeholder is so common that a failing parse is too dear.
            field = F.nullif(field, F.lit(NOT_QUOTED)).try_cast(kind)
        return field.alias(name)

    rows = F.filter(F.col("_lines"), lambda line: line != F.col("_lines")[0])
    return (
        read_csv(payloads, "price csv", schema, text, on_bad)
        .select(*others, F.explode(rows).alias("_line"))
        # One parse for all fields: read apart, or in filters, each would parse the line.
        .select(*others, F.explode(F.array(F.from_csv("_line", as_text))).alias("_row"))
        .select(*others, *[typed(name, kind) for name, kind in fields])
    )


def _generated(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once, however many readers it has."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def standardize_prices(
    rows: DataFrame, source: str | Column, ingested_at: Column | None = None
) -> DataFrame:
    """Snapshot rows (``Symbol, Date, Time, ..., Close``) to market rows."""
    day = F.try_to_timestamp("Date", F.lit("yyyy-MM-dd"))
    moment = F.try_to_timestamp(F.concat_ws(" ", "Date", "Time"), F.lit("yyyy-MM-dd HH:mm:ss"))
    stamp = F.when(F.length("Time") > 0, F.coalesce(moment, day)).otherwise(day)
    usable = rows.filter(F.col("Symbol").isNotNull() & F.col("Close").isNotNull())
    market = _generated(usable, "market_time", stamp).filter("market_time is not null")
    market = market.withColumns({"price": F.col("Close"), "currency": second_part(F.col("Symbol"))})
    return _stamped(market.withColumnRenamed("Symbol", "symbol"), source, ingested_at)


def standardize_price_history(
    rows: DataFrame,
    start: str | date,
    end: str | date,
    source: str | Column,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Daily history rows (``symbol, Date, ..., Close``) inside a date range."""
    stamped = _generated(rows, "market_time", F.try_to_timestamp("Date", F.lit("yyyy-MM-dd")))
    market = (
        stamped.withColumns({"symbol": F.upper("symbol"), "price": F.col("Close")})
        .filter(in_range(F.to_date("market_time"), start, end))
        .withColumn("currency", second_part(F.col("symbol")))
    )
    return _stamped(market, source, ingested_at)


def in_range(day: Column, start: str | date | None, end: str | date | None) -> Column:
    """Whether a date lies in a range; a missing end is open."""
    found = F.lit(True)
    if start is not None:
        found &= day >= F.lit(start).cast("date")
    if end is not None:
        found &= day <= F.lit(end).cast("date")
    return found


def parse_candles(
    payloads: DataFrame,
    source: str | Column = "finnhub_backfill",
    ingested_at: Column | None = None,
    text: str = "payload",
    start: str | date | None = None,
    end: str | date | None = None,
    on_bad: str = "raise",
) -> DataFrame:
    """Daily-candle JSON ``{s, c[], t[]}`` per symbol to market rows of a date range."""
    market = (
        read(payloads, "candles", text, on_bad)
        # A condition inside the generator: a filter would parse the JSON again.
        .select(
            "symbol",
            F.explode(
                F.when((F.col("_p.s") == "ok") & (F.size("_p.c") > 0), F.arrays_zip("_p.c", "_p.t"))
            ).alias("bar"),
        )
        .select(
            F.upper("symbol").alias("symbol"),
            F.col("bar.c").alias("price"),
            suffix_or_us(F.col("symbol")).alias("currency"),
            _midnight(F.timestamp_seconds("bar.t")).alias("market_time"),
        )
    )
    return _stamped(market.filter(in_range(F.to_date("market_time"), start, end)), source, ingested_at)


def parse_quotes(
    payloads: DataFrame,
    source: str | Column = "finnhub_snapshot",
    ingested_at: Column | None = None,
    text: str = "payload",
    on_bad: str = "raise",
) -> DataFrame:
    """Quote JSON ``{c, t}`` per symbol to one market row each.

    No row without a price (null or zero); a quote without a time is from now.
    """
    now = F.current_timestamp() if ingested_at is None else ingested_at
    market = (
        read(payloads, "quotes", text, on_bad)
        .withColumn("_quote", F.explode(F.filter(F.array("_p"), lambda q: q["c"] != 0)))
        .withColumns(
            {
                "price": F.col("_quote.c"),
                "currency": suffix_or_us(F.col("symbol")),
                "market_time": _midnight(
                    F.coalesce(F.timestamp_seconds(F.nullif("_quote.t", F.lit(0))), now)
                ),
                "symbol": F.upper("symbol"),
            }
        )
    )
    return _stamped(market, source, ingested_at)


def standardize_bars(
    bars: DataFrame,
    source: str | Column = "yfinance_backfill",
    ingested_at: Column | None = None,
    start: str | date | None = None,
    end: str | date | None = None,
) -> DataFrame:
    """Daily bars ``(symbol, bar_date, close)`` of a date range to market rows."""
    market = bars.filter(in_range(F.col("bar_date"), start, end)).select(
        "*",
        F.col("close").alias("price"),
        suffix_or_us(F.col("symbol")).alias("currency"),
        _midnight(F.col("bar_date")).alias("market_time"),
    ).withColumn("symbol", F.upper("symbol"))
    return _stamped(market, source, ingested_at)


def latest_bar(
    bars: DataFrame,
    as_of: str | date,
    days: int = 5,
    source: str | Column = "yfinance_snapshot",
    ingested_at: Column | None = None,
) -> DataFrame:
    """Last bar per symbol among the last ``days`` days."""
    until = F.lit(as_of).cast("date")
    recent = bars.filter(F.col("bar_date").between(F.date_sub(until, days - 1), until))
    last = dedupe_latest(recent, ["symbol"], ["bar_date"], ["close"])
    return standardize_bars(last, source, ingested_at)


def _key(symbol: Column) -> Column:
    """A symbol's spelling for comparisons: case and outer blanks do not count."""
    return F.upper(F.trim(symbol))


def choose_history_source(requested: DataFrame, history: DataFrame) -> DataFrame:
    """Per requested symbol, the first spelling that has history rows.

    Returns ``symbol, attempts, source_key, source_symbol, rows``: the spellings
    tried in order up to the first with rows, and that spelling (null if none has
    any). A symbol asked for more than once, in whatever case, is one request,
    under its smallest spelling. Only history under one of the spellings is counted.
    """
    asked = requested.groupBy(_key(F.col("symbol")).alias("_key")).agg(F.min("symbol").alias("symbol"))
    tried = asked.select("symbol", F.posexplode(history_variants(F.col("symbol")))).select(
        "symbol", "pos", F.col("col").alias("source_symbol"), _key(F.col("col")).alias("source_key")
    )
    landed = (
        history.select(_key(F.col("source_symbol")).alias("source_key"))
        .join(tried.select("source_key"), "source_key", "left_semi")
        .groupBy("source_key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    attempts = (
        tried.join(landed, "source_key", "left")
        .withColumn("rows", F.coalesce("rows", F.lit(0)))
        .groupBy("symbol")
        # At most three spellings per symbol.
        .agg(F.array_sort(F.collect_list(F.struct("pos", "source_symbol", "rows", "source_key"))).alias("tried"))
    )
    hit = F.try_element_at(F.filter("tried", lambda t: t["rows"] > 0), F.lit(1))
    return attempts.withColumn("hit", hit).select(
        "symbol",
        F.transform(
            F.filter("tried", lambda t: F.col("hit").isNull() | (t["pos"] <= F.col("hit.pos"))),
            lambda t: F.concat(t["source_symbol"], F.lit(":"), t["rows"].cast("string")),
        ).alias("attempts"),
        F.col("hit.source_key").alias("source_key"),
        F.col("hit.source_symbol").alias("source_symbol"),
        F.coalesce("hit.rows", F.lit(0)).alias("rows"),
    )


def first_available_source(
    requested: DataFrame,
    history: DataFrame,
    snapshots: DataFrame,
    start: str | date,
    end: str | date,
    source: str = "stooq_backfill",
    ingested_at: Column | None = None,
) -> DataFrame:
    """History under the best spelling per symbol, else the symbol's snapshot row.

    ``history`` holds raw daily rows with their ``source_symbol``; ``snapshots``
    holds market rows, which come back tagged as a fallback. Symbols are compared
    whatever their case; history comes back under the symbol asked for.
    """
    choice = choose_history_source(requested, history)
    chosen = history.withColumn("source_key", _key(F.col("source_symbol"))).join(
        choice.select("symbol", "source_key"), "source_key"
    )
    missing = choice.filter("source_key is null").select(_key(F.col("symbol")).alias("_key"))
    fallback = (
        snapshots.withColumn("_key", _key(F.col("symbol")))
        .join(missing, "_key", "left_semi")
        .drop("_key")
        .withColumn("_source", F.lit(f"{source}_snapshot_fallback"))
    )
    return standardize_price_history(chosen, start, end, source, ingested_at).unionByName(fallback)


def load_report(requested: DataFrame, history: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One row per requested symbol: how it was loaded, and a printable token."""
    choice = choose_history_source(requested, history).withColumn("_key", _key(F.col("symbol")))
    has_snapshot = snapshots.select(_key(F.col("symbol")).alias("_key")).distinct().withColumn("_snapshot", F.lit(True))
    status = (
        F.when(F.col("source_symbol").isNotNull(), "ok")
        .when(F.col("_snapshot"), "snapshot_fallback")
        .otherwise("empty")
    )
    fallback = F.col("status") == "snapshot_fallback"
    report = (
        choice.join(has_snapshot, "_key", "left")
        .withColumn("status", status)
        .withColumn("source_symbol", F.when(fallback, F.lower("symbol")).otherwise(F.col("source_symbol")))
        .withColumn("rows", F.when(fallback, F.lit(1)).otherwise(F.col("rows")))
    )
    loaded = F.concat(
        F.lit("["), "source_symbol", F.lit(";rows="), F.col("rows").cast("string"), F.lit("]")
    )
    tried = F.coalesce(F.nullif(F.array_join("attempts", ","), F.lit("")), F.lit("no-attempts"))
    detail = F.when(F.col("status") == "empty", F.concat(F.lit("["), tried, F.lit("]"))).otherwise(loaded)
    return report.select(
        "symbol",
        "status",
        "source_symbol",
        "rows",
        F.concat("symbol", F.lit("="), "status", detail).alias("token"),
    )


def report_counts(report: DataFrame) -> DataFrame:
    """Symbols and rows per status."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("symbols"), F.sum("rows").alias("rows"))
