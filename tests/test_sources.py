"""Payloads of every feed, with the odd ones."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import rows
from tidegauge.sources.payloads import rejected
from tidegauge.sources import indicators, prices, rates
from tidegauge.sources.schemas import PRICE_HISTORY_CSV, PRICE_SNAPSHOT_CSV, TABLES
from tidegauge.sources.tables import empty


def payloads(spark, *texts, **columns):
    names = list(columns)
    data = [(*[columns[n] for n in names], t) for t in texts]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in [*names, "payload"]))


def test_snapshot_csv(spark):
    header = "Symbol,Date,Time,Open,High,Low,Close,Volume"
    text = (
        f"\n{header}\r\n\r\nSPY.US,2024-03-01,22:00:00,1,2,0.5,1.5,100\r\n"
        "QQQ.US,2024-03-01,,1,2,0.5,2.5,\n"
        "BAD.US,N/D,N/D,N/D,N/D,N/D,N/D,N/D\n"
        "XXX.US,2024-03-01,22:00:00,1,2,0.5,junk,1\n"
        f"{header}\n"
        "NODATE.US,N/D,22:00:00,1,2,3,4,5\n"
    )
    parsed = prices.parse_price_csv(payloads(spark, text, "No data", "", header), PRICE_SNAPSHOT_CSV)
    assert parsed.count() == 5
    market = prices.standardize_prices(parsed, "feed")
    assert rows(market, "symbol", "price", "currency", "market_time", "_source") == [
        ("QQQ.US", 2.5, "US", datetime(2024, 3, 1), "feed"),
        ("SPY.US", 1.5, "US", datetime(2024, 3, 1, 22), "feed"),
    ]


def test_history_csv_keeps_the_closed_range(spark):
    text = "Date,Open,High,Low,Close,Volume\n" + "\n".join(
        f"2024-01-0{d},1,1,1,{d},1" for d in range(1, 6)
    ) + "\nsoon,1,1,1,1,1"
    parsed = prices.parse_price_csv(payloads(spark, text, symbol="spy.us"), PRICE_HISTORY_CSV)
    market = prices.standardize_price_history(parsed, "2024-01-02", "2024-01-04", "feed")
    assert rows(market, "symbol", "price", "currency") == [
        ("SPY.US", float(p), "US") for p in (2, 3, 4)
    ]


def test_candles(spark):
    good = json.dumps({"s": "ok", "c": [1.5, 2.5], "t": [1704067200, 1704153600 + 3600]})
    bad = [
        json.dumps({"s": "no_data", "c": [1.0], "t": [1704067200]}),
        json.dumps({"s": "ok", "c": [], "t": []}),
        json.dumps({"s": "ok"}),
    ]
    market = prices.parse_candles(payloads(spark, good, *bad, symbol="spot"))
    assert rows(market, "symbol", "price", "currency", "market_time") == [
        ("SPOT", 1.5, "US", datetime(2024, 1, 1)),
        ("SPOT", 2.5, "US", datetime(2024, 1, 2)),
    ]


def test_quotes(spark):
    now = F.lit("2024-05-05 10:00:00").cast("timestamp")
    texts = ['{"c": 2.5, "t": 1704070800}', '{"c": 3.5}', '{"c": 4.5, "t": 0}', '{"c": 0, "t": 1}', "{}"]
    market = prices.parse_quotes(payloads(spark, *texts, symbol="spy.us"), ingested_at=now)
    assert rows(market, "symbol", "price", "currency", "market_time") == [
        ("SPY.US", 2.5, "us", datetime(2024, 1, 1)),
        ("SPY.US", 3.5, "us", datetime(2024, 5, 5)),
        ("SPY.US", 4.5, "us", datetime(2024, 5, 5)),
    ]


def test_latest_bar(spark):
    bars = spark.createDataFrame(
        [("a.us", date(2024, 1, d), float(d)) for d in (1, 8, 9)] + [("b.us", date(2024, 1, 2), 7.0)],
        "symbol string, bar_date date, close double",
    )
    last = prices.latest_bar(bars, "2024-01-10")
    assert rows(last, "symbol", "price", "market_time") == [("A.US", 9.0, datetime(2024, 1, 9))]


def test_fx_latest(spark):
    texts = [
        '{"base": "GBP", "date": "2024-03-01", "rates": {"USD": 1.25, "EUR": null}}',
        '{"base": "EUR", "date": "2024-03-01"}',
        '{"date": "2024-03-02", "rates": {"USD": 1.0}}',
    ]
    got = rates.parse_fx_latest(payloads(spark, *texts, source_url="u"), "r1")
    assert got.columns == [c.split()[0] for c in TABLES["fx_rates_raw"][1].split(", ")]
    assert rows(got, "base_currency", "quote_currency", "rate", "rate_timestamp", "run_id") == [
        ("GBP", "EUR", None, datetime(2024, 3, 1), "r1"),
        ("GBP", "USD", 1.25, datetime(2024, 3, 1), "r1"),
        (None, "USD", 1.0, datetime(2024, 3, 2), "r1"),
    ]


def test_fx_range(spark):
    text = '{"base": "GBP", "rates": {"2024-03-01": {"USD": 1.2, "JPY": 190}, "2024-03-04": {"USD": null}}}'
    got = rates.parse_fx_range(payloads(spark, text, source_url="u"), "r1")
    assert rows(got, "quote_currency", "rate", "rate_timestamp") == [
        ("JPY", 190.0, datetime(2024, 3, 1)),
        ("USD", 1.2, datetime(2024, 3, 1)),
        ("USD", None, datetime(2024, 3, 4)),
    ]


def macro_row(code, iso, indicator, title, year, value):
    country = {"id": code, "value": f"Land {code}"}
    return {"country": country, "countryiso3code": iso, "indicator": {"id": indicator, "value": title},
            "date": year, "value": value}


def test_macro_page(spark):
    landed = [
        macro_row("NZ", "NZL", "X.WOOL", "Wool exports (tonnes)", "2019", 120500),
        macro_row("IS", "ISL", "X.FISH", "Fish landed (share of trade)", "2021", 37.25),
        macro_row("CL", "CHL", "X.CU", "Copper, refined", "2020", None),
    ]
    page = json.dumps([{"page": 2, "pages": 4, "total": 3}, landed])
    got = indicators.parse_macro_pages(payloads(spark, page))
    assert rows(got, "country_code", "indicator_name", "observation_date", "observation_value") == [
        ("CHL", "Copper, refined", "2020", None),
        ("ISL", "Fish landed (share of trade)", "2021", 37.25),
        ("NZL", "Wool exports (tonnes)", "2019", 120500.0),
    ]
    raw = [json.loads(r[0]) for r in got.select("raw_payload").collect()]
    assert sorted(raw, key=lambda r: r["countryiso3code"]) == sorted(landed, key=lambda r: r["countryiso3code"])
    assert rows(indicators.page_counts(payloads(spark, page))) == [(4,)]


def test_macro_page_fallbacks_and_skips(spark):
    row = {"country": {"id": "ZZ"}, "countryiso3code": "", "indicator": {"id": "I", "value": ""},
           "date": 2020, "value": ""}
    pages = [
        json.dumps([{"total": 0}, []]),
        json.dumps([None, None]),
        json.dumps([{"pages": 3}, [row, None, "note", 5, {"value": "1.5"}]]),
    ]
    got = indicators.parse_macro_pages(payloads(spark, *pages))
    assert rows(got.drop("raw_payload")) == [("ZZ", "I", "2020", None), (None, None, None, 1.5)]
    assert rows(indicators.page_counts(payloads(spark, *pages))) == [(1,), (1,), (3,)]


@pytest.mark.parametrize("text", ['{"message": "no"}', "[1]", "oops"])
def test_macro_page_of_another_shape_fails(spark, text):
    with pytest.raises(PySparkException, match="Macro page"):
        indicators.parse_macro_pages(payloads(spark, text)).collect()


def test_sources_per_symbol(spark):
    requested = spark.createDataFrame([("A.US",), ("B.US",), ("C.X.US",), ("D.US",)], "symbol string")
    history = spark.createDataFrame(
        [("a.us", "2024-01-01", 1.0), ("a", "2024-01-01", 9.0), ("c", "2024-01-01", 3.0),
         ("c", "2030-01-01", 4.0)],
        "source_symbol string, Date string, Close double",
    )
    snapshots = empty(spark, "market_prices_raw").unionByName(
        spark.createDataFrame(
            [(s, 2.0, "US", datetime(2024, 1, 2), datetime(2024, 1, 2), date(2024, 1, 2), "snap")
             for s in ("A.US", "B.US")],
            TABLES["market_prices_raw"][1],
        )
    )
    got = prices.first_available_source(
        requested, history, snapshots, "2024-01-01", "2024-12-31", "stooq_backfill"
    )
    assert rows(got, "symbol", "price", "currency", "_source") == [
        ("A.US", 1.0, "US", "stooq_backfill"),
        ("B.US", 2.0, "US", "stooq_backfill_snapshot_fallback"),
        ("C.X.US", 3.0, "X", "stooq_backfill"),
    ]
    report = prices.load_report(requested, history, snapshots)
    assert rows(report, "token") == [
        ("A.US=ok[a.us;rows=1]",), ("B.US=snapshot_fallback[b.us;rows=1]",), ("C.X.US=ok[c;rows=2]",),
        ("D.US=empty[d.us:0,d:0]",),
    ]
    assert rows(prices.report_counts(report)) == [("empty", 1, 0), ("ok", 2, 3), ("snapshot_fallback", 1, 1)]


def test_sources_are_found_in_any_case_and_once(spark):
    requested = spark.createDataFrame([("spy.us",), ("SPY.US",), ("qqq.us",), ("dia.us",)], "symbol string")
    history = spark.createDataFrame([("QQQ.US", "2024-01-01", 1.0)], "source_symbol string, Date string, Close double")
    quoted = prices.parse_quotes(payloads(spark, '{"c": 5.0, "t": 1704067200}', symbol="spy.us"))
    got = prices.first_available_source(requested, history, quoted, "2024-01-01", "2024-12-31")
    assert rows(got, "symbol", "price") == [("QQQ.US", 1.0), ("SPY.US", 5.0)]
    statuses = rows(prices.load_report(requested, history, quoted), "symbol", "status")
    assert statuses == [("SPY.US", "snapshot_fallback"), ("dia.us", "empty"), ("qqq.us", "ok")]


VALID = {
    "candles": '{"s":"no_data"}', "quotes": '{"c":null}', "fx_latest": '{"base":"A","date":"x"}', "fx_range": "{}",
}
OUT_OF_SHAPE = {
    "candles": '{"s":"ok","c":[1.0,2.0],"t":[1]}', "quotes": "[1]",
    "fx_latest": '{"base":"A","date":"02.01.2024","rates":{"B":1.0}}',
    "fx_range": '{"base":"A","rates":{"02.01.2024":{"B":1.0}}}',
}


def feed_parser(feed):
    parsers = {"candles": prices.parse_candles, "quotes": prices.parse_quotes}
    fx = {"fx_latest": rates.parse_fx_latest, "fx_range": rates.parse_fx_range}
    return parsers[feed] if feed in parsers else lambda df, **k: fx[feed](df, "run", **k)


@pytest.mark.parametrize("feed", list(VALID))
def test_broken_payloads_fail_or_are_listed(spark, feed):
    bad = ['{"s":"ok","c":[1.0', "<html>busy</html>", "", None, OUT_OF_SHAPE[feed]]
    for text in bad:
        landed = spark.createDataFrame([("s", "u", text)], "symbol string, source_url string, payload string")
        with pytest.raises(PySparkException, match=feed):
            feed_parser(feed)(landed).collect()
    landed = spark.createDataFrame(
        [("s", "u", t) for t in [*bad, VALID[feed]]], "symbol string, source_url string, payload string"
    )
    assert feed_parser(feed)(landed, on_bad="skip").count() == 0
    listed = rejected(landed, feed).select("payload").collect()
    assert sorted(str(r[0]) for r in listed) == sorted(map(str, bad))
    with pytest.raises(ValueError, match="on_bad"):
        feed_parser(feed)(landed, on_bad="ignore")


def test_candles_and_bars_of_a_range(spark):
    text = '{"s":"ok","c":[1.0,2.0,3.0],"t":[1704067200,1704153600,1704240000]}'
    got = prices.parse_candles(payloads(spark, text, symbol="a.us"), start="2024-01-02", end="2024-01-02")
    assert rows(got, "price") == [(2.0,)]
    bars = spark.createDataFrame([("a", date(2024, 1, d), float(d)) for d in (1, 2, 3)], "symbol string, bar_date date, close double")
    assert rows(prices.standardize_bars(bars, start="2024-01-02"), "price") == [(2.0,), (3.0,)]



def test_a_line_and_its_time_are_parsed_once(spark):
    text = "Date,Open,High,Low,Close,Volume\n2024-01-01,1,2,3,4.5,6\n"
    parsed = prices.parse_price_csv(payloads(spark, text, symbol="a.us"), PRICE_HISTORY_CSV)
    got = prices.standardize_price_history(parsed, "2024-01-01", "2024-01-02", "feed")
    assert rows(got, "price") == [(4.5,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv(") == 1 and plan.count("gettimestamp(") + plan.count("try_to_timestamp(") <= 1


def test_broken_csv_and_pages_are_refused(spark):
    page, rows_of_page = "<html>\n<body>busy</body></html>", '[{"pages":1},[{"date":"2024","value":1.5}]]'
    header = "Symbol,Date,Time,Open,High,Low,Close,Volume"
    row = "A.US,2024-01-02,22:00:00,1,2,0.5,1.5,10"
    good = [f"\ufeff{header}\n{row}", f'"Symbol","Date",Time,Open,High,Low,Close,Volume\n{row}', "No data", "", " \n"]
    landed = payloads(spark, *good, page, "garbage", f"{header},More\n{row},1", None)
    parsed = prices.parse_price_csv(landed, PRICE_SNAPSHOT_CSV, on_bad="skip")
    assert [r["Symbol"] for r in parsed.collect()] == ["A.US", "A.US"]
    assert rejected(landed, "price_csv").count() == 4
    with pytest.raises(Exception, match="not the CSV header expected: garbage"):
        prices.parse_price_csv(payloads(spark, "garbage"), PRICE_SNAPSHOT_CSV).collect()
    pages = payloads(spark, rows_of_page, '[{"total":0},null]', '[{"total":0},[]]', "[1,2]", '[{"a":1},5]', page, None)
    assert indicators.parse_macro_pages(pages, on_bad="skip").count() == 1
    assert rejected(pages, "macro_pages").count() == 4
    assert indicators.page_counts(pages, on_bad="skip").count() == 3
    with pytest.raises(Exception, match="metadata and rows"):
        indicators.parse_macro_pages(payloads(spark, page)).collect()
