"""Feed payloads, written from the given tables one text per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.sources import prices
from tidegauge.sources.schemas import PRICE_SNAPSHOT_CSV
from workload.bindings import AS_OF, table


def loaded_at() -> Column:
    return F.lit(f"{AS_OF} 06:30:00").cast("timestamp")


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def price_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot CSV: a quoted row, a blank line and a row without a price."""
    symbol = _text("P", F.col("l_partkey"), ".US")
    time = F.when(F.col("l_linenumber") % 2 == 1, "22:00:00").otherwise("")
    text = _text(
        "Symbol,Date,Time,Open,High,Low,Close,Volume\n",
        symbol, ",", _day("l_shipdate"), ",", time, ",1.5,2.5,0.5,",
        F.col("l_extendedprice"), ",", F.col("l_quantity").cast("int"), "\r\n\r\n",
        symbol, ",N/D,N/D,N/D,N/D,N/D,N/D,N/D\n",
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.when(F.col("l_linenumber") == 7, "No data").otherwise(text).alias("payload"),
    )


def history_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History CSV of two days per symbol."""
    return table(spark, sf_dir, "lineitem").select(
        _text("s", F.col("l_suppkey"), ".us").alias("symbol"),
        _text(
            "Date,Open,High,Low,Close,Volume\n",
            _day("l_shipdate"), ",1,2,0.5,", F.col("l_extendedprice"), ",10\n",
            F.date_format(F.date_add("l_shipdate", 1), "yyyy-MM-dd"), ",1,2,0.5,",
            F.col("l_quantity"), ",10\n",
        ).alias("payload"),
    )


def _epoch(column: str, days: int = 0) -> Column:
    return F.unix_seconds(F.col(column).cast("timestamp")) + days * 86400


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two candles per payload; other states than ``ok`` and empty lists occur."""
    state = F.when(F.col("l_returnflag") == "N", "no_data").otherwise("ok")
    bars = _text(
        '"c":[', F.col("l_extendedprice"), ",", F.col("l_quantity"), '],"t":[',
        _epoch("l_shipdate") + 3600, ",", _epoch("l_shipdate", 1), "]",
    )
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_suppkey") % 2 == 0, _text("s", F.col("l_suppkey"), ".us"))
        .otherwise(_text("s", F.col("l_suppkey")))
        .alias("symbol"),
        _text(
            '{"s":"', state, '",',
            F.when(F.col("l_linenumber") == 7, '"c":[],"t":[]').otherwise(bars), "}",
        ).alias("payload"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes; some without a price, with a zero price or without a time."""
    price = (
        F.when(F.col("l_linenumber") == 1, "0")
        .when(F.col("l_linenumber") == 2, "null")
        .otherwise(F.col("l_extendedprice").cast("string"))
    )
    stamp = F.when(F.col("l_linenumber") == 3, "").otherwise(
        _text(',"t":', _epoch("l_shipdate") + 7200)
    )
    return table(spark, sf_dir, "lineitem").select(
        _text("s", F.col("l_suppkey"), ".us").alias("symbol"),
        _text('{"c":', price, stamp, "}").alias("payload"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _text("s", F.col("l_suppkey"), ".us").alias("symbol"),
        F.to_date("l_shipdate").alias("bar_date"),
        F.col("l_extendedprice").alias("close"),
    )


def fx_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of one date, one of them null; some payloads have no rates."""
    rates = _text(
        ',"rates":{"', F.col("o_orderpriority"), '":', F.col("o_totalprice"), ',"NUL":null}'
    )
    return table(spark, sf_dir, "orders").select(
        _text("orders/", F.col("o_orderkey")).alias("source_url"),
        _text(
            '{"amount":1.0,"base":"', F.col("o_orderstatus"), '","date":"', _day("o_orderdate"), '"',
            F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(rates), "}",
        ).alias("payload"),
    )


def fx_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of two dates."""
    next_day = F.date_format(F.date_add("o_orderdate", 1), "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        _text("orders/", F.col("o_orderkey")).alias("source_url"),
        _text(
            '{"base":"', F.col("o_orderstatus"), '","rates":{"', _day("o_orderdate"), '":{"',
            F.col("o_orderpriority"), '":', F.col("o_totalprice"), ',"NUL":null},"', next_day,
            '":{"', F.col("o_orderpriority"), '":', F.col("o_orderkey"), "}}}",
        ).alias("payload"),
    )


def macro_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with codes or ids left blank, entries that are no rows, empty pages."""
    blank = F.col("o_orderkey") % 3 == 0
    row = _text(
        '{"country":{"id":"', F.col("o_orderstatus"), '","value":"Name"},"countryiso3code":"',
        F.when(blank, "").otherwise(_text(F.col("o_orderstatus"), "XX")),
        '","indicator":{"id":"', F.col("o_orderpriority"), '","value":"',
        F.when(blank, "").otherwise("Orders, total"), '"},"date":"', F.year("o_orderdate"),
        '","value":', F.col("o_totalprice"), "}",
    )
    missing = _text(
        '{"country":{"id":"', F.col("o_orderstatus"), '"},"indicator":{"id":"',
        F.col("o_orderpriority"), '"},"date":', F.year("o_orderdate"), ',"value":null}',
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("page_key"),
        F.when(F.col("o_orderkey") % 13 == 0, '[{"page":1,"total":0},[]]')
        .when(F.col("o_orderkey") % 17 == 0, "[null,null]")
        .otherwise(
            _text('[{"page":1,"pages":', F.col("o_orderkey") % 7 + 1, "},[", row, ",", missing,
                  ',null,"note",5]]')
        )
        .alias("payload"),
    )


def _supplier_symbol(key: str) -> Column:
    return _text("S", F.col(key), ".L.US")


def requested_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(_supplier_symbol("s_suppkey").alias("symbol"))


def landed_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows under one of three spellings; a quarter of the symbols have none."""
    spelling = (
        F.when(F.col("l_suppkey") % 4 == 0, _text("s", F.col("l_suppkey"), ".l.us"))
        .when(F.col("l_suppkey") % 4 == 1, _text("s", F.col("l_suppkey"), ".l"))
        .when(F.col("l_suppkey") % 4 == 2, _text("s", F.col("l_suppkey")))
        .otherwise(_text("other", F.col("l_suppkey")))
    )
    return table(spark, sf_dir, "lineitem").select(
        spelling.alias("source_symbol"),
        _day("l_shipdate").alias("Date"),
        F.col("l_extendedprice").alias("Close"),
    )


def _snapshot_rows(rows: DataFrame, symbol: Column, price: Column) -> DataFrame:
    """Market rows parsed from snapshot CSV; a symbol without a price gives none."""
    text = _text("Symbol,Date,Time,Open,High,Low,Close,Volume\n", symbol, f",{AS_OF},,1,1,1,", price, ",1\n")
    landed = prices.parse_price_csv(rows.select(text.alias("payload")), PRICE_SNAPSHOT_CSV)
    return prices.standardize_prices(landed, "stooq_snapshot", loaded_at())


def landed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One market row per supplier; an eighth of them is quoted without a price."""
    price = F.when(F.col("s_suppkey") % 8 == 7, "N/D").otherwise(F.col("s_acctbal").cast("string"))
    return _snapshot_rows(table(spark, sf_dir, "supplier"), _supplier_symbol("s_suppkey"), price)


def nation_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One market row per nation, every other one quoted without a price."""
    key = F.col("n_nationkey")
    price = F.when(key % 2 == 1, "N/D").otherwise("1.5")
    return _snapshot_rows(table(spark, sf_dir, "nation"), _text("n", key, ".us"), price)


def nation_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(_text("N", F.col("n_nationkey"), ".US").alias("symbol"))


def nation_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 3 == 0, _text("n", key))
        .when(key % 3 == 1, _text("n", key, ".us"))
        .otherwise("other")
        .alias("source_symbol")
    )


def vendor_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("part_key"),
        F.when(key % 10 == 0, "VIX.US")
        .when(key % 10 == 1, "DXY.US")
        .when(key % 10 == 2, "spot")
        .otherwise(_text("p", key, ".us"))
        .alias("symbol"),
    )


def broken(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A feed's payloads, some of them cut off, an error page, or out of shape."""
    key, rows, odd = {
        "candles": (F.col("l_partkey"), "lineitem", '{"s":"ok","c":[1.0,2.0],"t":[1]}'),
        "quotes": (F.col("l_partkey"), "lineitem", "[1.5]"),
        "fx_latest": (F.col("o_custkey"), "orders", '{"base":"A","date":"02.01.2024","rates":{"B":1.0}}'),
        "fx_range": (F.col("o_custkey"), "orders", '{"base":"A","rates":{"02.01.2024":{"B":1.0}}}'),
        "price_csv": (F.col("l_partkey"), "lineitem", "Symbol,Date\nA.US,2024-01-02\n"),
        "price_history_csv": (F.col("l_partkey"), "lineitem", "2024-01-02,1,1,1,1,1\n"),
        "macro_pages": (F.col("o_custkey"), "orders", '[{"pages":1}]'),
    }[feed]
    whole = {
        "candles": '{"s":"ok","c":[1.0],"t":[1]}', "quotes": '{"c":1.5}',
        "fx_latest": '{"base":"A","date":"2024-01-02","rates":{"B":1.0}}',
        "fx_range": '{"base":"A","rates":{}}', "price_csv": "Symbol,Date,Time,Open,High,Low,Close,Volume\n",
        "price_history_csv": " date,Open,High,Low,Close,Volume\r\n2024-01-02,1,1,1,1,1",
        "macro_pages": '[{"pages":1},[]]',
    }[feed]
    kind = key % 20
    # A CSV text that is cut off in a row still has its header.
    cut = "<html>\n<body>busy</body></html>" if feed.endswith("csv") else whole[:-3]
    bare = {"macro_pages": '[{"total":0},null]'}.get(feed, "No data" if feed.endswith("csv") else "{}")
    text = (
        F.when(kind == 0, cut)
        .when(kind == 1, "<html>busy</html>")
        .when(kind == 2, odd)
        .when(kind == 3, F.lit(None).cast("string"))
        .when(kind == 4, bare)
        .otherwise(whole)
    )
    return table(spark, sf_dir, rows).select(key.alias("landed_key"), text.alias("payload"))
