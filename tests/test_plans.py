"""Silver, Gold, checks and measures on small tables with known results."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import day, noon, price_rows, rows
from tidegauge.plans import checks, measures
from tidegauge.plans.cross import cross_signal_summary
from tidegauge.plans.fx import fx_trends
from tidegauge.plans.macro import macro_trends, macro_trends_legacy
from tidegauge.plans.market import market_snapshot
from tidegauge.plans.movers import top_movers_why
from tidegauge.plans.silver import clean_fx, clean_macro, clean_market, typed_prices
from tidegauge.sources.schemas import TABLES, columns_of
from tidegauge.sources.tables import empty


def table(spark, name, data):
    return spark.createDataFrame(data, TABLES[name][1])


def test_clean_market(spark):
    at, late, early = noon(0), noon(1), noon(0, 13)
    raw = [
        ("A", 1.00005, "US", at, early, day(0), "one"),
        ("A", 2.0, "US", at, late, day(1), "two"),
        ("A", 3.0, "US", at, late, day(1), "one"),
        ("A", None, "US", noon(2), late, day(1), "one"),
        ("A", 1e12, "US", noon(3), late, day(1), "one"),
        (None, 1.0, "US", at, late, day(1), "one"),
        ("A", 1.00005, "US", None, late, day(1), "one"),
        ("B", 1.00005, "US", at, late, day(1), "one"),
    ]
    got = clean_market(table(spark, "market_prices_raw", raw))
    assert got.columns == columns_of("market_prices")
    assert [(r[0], str(r[1])) for r in rows(got)] == [("A", "3.0000"), ("B", "1.0001")]


def test_clean_fx(spark):
    at = noon(0)
    raw = [
        ("GBP", "USD", 1.234567, at, None, "u", noon(1), "r"),
        ("GBP", "USD", 1.3, at, "bank", "u", noon(2), "r"),
        ("GBP", "EUR", 1.234565, at, None, "u", noon(1), "r"),
        ("GBP", "JPY", None, at, None, "u", noon(1), "r"),
        ("GBP", "ZWL", 1e9, at, None, "u", noon(1), "r"),
    ]
    got = clean_fx(table(spark, "fx_rates_raw", raw))
    assert rows(got, "currency_pair", "rate_date", "source_system") == [
        ("GBPEUR", day(0), "frankfurter"),
        ("GBPUSD", day(0), "bank"),
        ("GBPZWL", day(0), "frankfurter"),
    ]
    assert sorted(str(r[0]) for r in rows(got, "rate")) == ["1.23457", "1.30000", "None"]


def test_clean_macro(spark):
    def raw(country, when, value, stamp):
        return (country, "i", when, value, "{}", stamp, day(0), "s")

    got = clean_macro(
        table(
            spark,
            "macro_indicators_raw",
            [
                raw("A", "2024", 1.0, noon(0)),
                raw("A", "2024", 2.0, noon(1)),
                raw("A", "2024Q1", 3.0, noon(1)),
                raw("A", "2023-07-01", 4.0, noon(1)),
                raw("A", "2022", None, noon(1)),
                raw(None, "2022", 1.0, noon(1)),
            ],
        )
    )
    assert rows(got, "observation_date", "observation_value") == [
        (date(2023, 7, 1), 4.0),
        (date(2024, 1, 1), 2.0),
    ]


def snapshot(spark, *series):
    data = [row for symbol, prices in series for row in price_rows(symbol, prices)]
    return market_snapshot(clean_market(table(spark, "market_prices_raw", data)))


def test_snapshot_of_short_series(spark):
    got = snapshot(spark, ("ONE", [10.0]), ("TWO", [10.0, 11.0]), ("ZERO", [0.0, 5.0]))
    assert got.columns == columns_of("daily_market_snapshot")
    picked = rows(
        got, "symbol", "latest_price", "open_price", "day_change_pct", "rolling_30d_volatility",
        "drawdown_from_90d_high_pct", "stress_flag",
    )
    assert picked == [
        ("ONE", 10.0, None, None, None, 0.0, False),
        ("TWO", 10.0, None, None, None, 0.0, False),
        ("TWO", 11.0, 10.0, 10.0, None, 0.0, False),
        ("ZERO", 0.0, None, None, None, None, False),
        ("ZERO", 5.0, 0.0, None, None, 0.0, False),
    ]


def test_snapshot_offsets_count_rows(spark):
    prices = [100.0 + i for i in range(95)]
    last = snapshot(spark, ("A", prices)).orderBy(F.col("snapshot_date").desc()).first()
    assert last["return_7d_pct"] == round(7 / 187 * 100, 4)
    assert last["return_30d_pct"] == round(30 / 164 * 100, 4)
    assert last["return_90d_pct"] == round(90 / 104 * 100, 4)
    assert last["drawdown_from_90d_high_pct"] == 0.0


def test_drawdown_looks_back_ninety_rows(spark):
    prices = [200.0] + [150.0 if i == 40 else 100.0 + i % 3 for i in range(1, 140)]
    got = snapshot(spark, ("A", prices)).orderBy("snapshot_date").collect()
    for i, row in enumerate(got):
        high = max(prices[max(0, i - 89) : i + 1])
        expected = (prices[i] - high) / high * 100
        assert row["drawdown_from_90d_high_pct"] == pytest.approx(expected, abs=5.1e-5)


def test_snapshot_takes_the_last_price_of_a_day(spark):
    raw = [
        ("A", 1.0, "US", noon(0, 9), noon(0, 10), day(0), "f"),
        ("A", 3.0, "US", noon(0, 17), noon(0, 18), day(0), "f"),
        ("A", 4.0, "US", noon(0, 17), noon(0, 19), day(0), "f"),
        ("A", 2.0, "US", noon(0, 12), noon(0, 20), day(0), "f"),
    ]
    bronze = table(spark, "market_prices_raw", raw)
    from_silver = market_snapshot(clean_market(bronze))
    assert rows(from_silver, "latest_price", "market_time") == [(4.0, noon(0, 17))]
    assert rows(from_silver) == rows(market_snapshot(typed_prices(bronze)))


@pytest.mark.parametrize(
    ("prices", "flag"),
    [([100.0, 98.0], True), ([100.0, 98.01], False), ([100.0] * 6 + [99.0] * 26 + [95.0] * 4, True)],
)
def test_snapshot_stress(spark, prices, flag):
    last = snapshot(spark, ("A", prices)).orderBy(F.col("snapshot_date").desc()).first()
    assert last["stress_flag"] is flag


def fx(spark, rates, step=timedelta(days=1), pair="GBPUSD"):
    data = []
    for i, rate in enumerate(rates):
        at = datetime(2024, 1, 1) + i * step
        data.append((pair, pair[:3], pair[3:], rate, at, at.date(), "s", at))
    return spark.createDataFrame(data, TABLES["fx_rates"][1].replace("decimal(12,5)", "double"))


def test_fx_signals(spark):
    got = fx_trends(fx(spark, [1.0, 1.0024, 1.0074, 1.002, 1.02]))
    assert got.columns == columns_of("fx_trend_signals")
    assert rows(got, "rate_date", "daily_change_pct", "trend_signal", "stress_flag") == [
        (day(0), None, "stable", False),
        (day(1), 0.24, "stable", False),
        (day(2), 0.498803, "strengthening", False),
        (day(3), -0.536033, "weakening", True),
        (day(4), 1.796407, "strengthening", True),
    ]


def test_fx_intraday_series_cross_slots(spark):
    """Forty-five rates in one hour, then one a day: offsets run across slots."""
    dense = fx(spark, [1 + i / 1000 for i in range(45)], timedelta(seconds=60))
    got = fx_trends(dense).orderBy("ingested_at").collect()
    sparse = fx_trends(fx(spark, [1 + i / 1000 for i in range(45)])).orderBy("ingested_at").collect()
    metrics = ("daily_change_pct", "weekly_change_pct", "return_30d_pct", "rolling_30d_volatility")
    assert [[r[m] for m in metrics] for r in got] == [[r[m] for m in metrics] for r in sparse]
    assert [r["return_30d_pct"] is None for r in got] == [True] * 30 + [False] * 15


def macro_silver(spark, values, first_year=2000):
    data = [
        ("GBR", "i", date(first_year + i, 1, 1), value, "{}", noon(0), day(0), "s")
        for i, value in enumerate(values)
    ]
    return spark.createDataFrame(data, TABLES["macro_indicators"][1])


def test_macro_trends(spark):
    got = macro_trends(macro_silver(spark, [10.0, 11.0, 11.0, 0.0, 5.0] + [1.0] * 7 + [20.0]))
    by_date = rows(got, "observation_date", "period_change", "period_change_pct", "trend_direction")
    assert [r[1:] for r in by_date[:5]] == [
        (None, None, "flat"), (1.0, 10.0, "up"), (0.0, 0.0, "flat"), (-11.0, -100.0, "down"),
        (5.0, None, "up"),
    ]
    assert rows(got, "observation_date", "year_over_year_pct")[-1] == (date(2012, 1, 1), 100.0)


def test_macro_trend_uses_the_rounded_change(spark):
    tiny = macro_silver(spark, [1.0, 1.0 + 1e-8])
    assert [r[0] for r in rows(macro_trends(tiny), "trend_direction")] == ["flat", "flat"]
    legacy = macro_trends_legacy(tiny)
    assert sorted(r[0] for r in rows(legacy, "trend_direction")) == ["flat", "increase"]


MARKET = "snapshot_date date, symbol string, latest_price double, day_change_pct double, return_30d_pct double, stress_flag boolean"
FX = "rate_date date, currency_pair string, trend_signal string, stress_flag boolean"
MACRO = "country_code string, indicator_name string, observation_date date, trend_direction string"


def movers_of(spark, returns, pairs, series, k, on=date(2019, 8, 14)):
    """Movers of one day from a 30-row return per symbol; stress below -3."""
    market = [(on, s, 40.0 + n, n / 10, r, r < -3) for n, (s, r) in enumerate(returns.items())]
    market.append((on - timedelta(days=6), "GONE", 7.0, 9.0, 99.0, True))
    fx_rows = [(on, f"NOK{n}", signal, stressed) for n, (signal, stressed) in enumerate(pairs)]
    macro = [(f"L{n}", "Trams per head", observed, trend) for n, (observed, trend) in enumerate(series)]
    return top_movers_why(
        spark.createDataFrame(market, MARKET), spark.createDataFrame(fx_rows, FX), spark.createDataFrame(macro, MACRO), k=k
    )


def test_top_movers(spark):
    got = movers_of(
        spark,
        {"KIWI": 0.75, "LAMA": 12.5, "MOTH": -8.25, "NEWT": 12.5, "OTTER": 3.0},
        [("weakening", True), ("weakening", False), ("stable", True), ("strengthening", False)],
        [(date(2018, 1, 1), "up"), (date(2017, 1, 1), "up"), (date(2018, 7, 1), "flat"), (date(2019, 1, 1), "down")],
        k=2,
    )
    assert got.columns == columns_of("top_movers_why")
    fx_text = "FX context: 1 strengthening, 2 weakening, 2 stressed pairs."
    macro_text = "Macro context: 2 up indicators, 1 down indicators."
    assert rows(got, "symbol", "fx_context", "macro_context") == [
        (symbol, fx_text, macro_text) for symbol in ("LAMA", "MOTH", "NEWT")
    ]
    assert got.filter("symbol = 'LAMA'").first()["why_summary"] == (
        f"Market stress flag is not active. 30d return indicates strong positive momentum. {fx_text} {macro_text}"
    )


def test_top_movers_ties_and_missing_context(spark):
    got = movers_of(
        spark, {"WREN": 2.5, "VOLE": 2.5, "XERUS": 0.0, "YAK": -2.5, "ZEBU": -2.5}, [], [(date(2031, 1, 1), "down")], k=1
    )
    assert rows(got, "symbol", "fx_context", "macro_context") == [
        (
            symbol,
            "FX context: 0 strengthening, 0 weakening, 0 stressed pairs.",
            "Macro context: 0 up indicators, 0 down indicators.",
        )
        for symbol in ("VOLE", "YAK")
    ]


def test_top_movers_fall_back_to_the_day_change(spark):
    market = spark.createDataFrame([(day(0), "NEW", 1.0, 2.0, None, None)], MARKET)
    got = top_movers_why(market, spark.createDataFrame([], FX), spark.createDataFrame([], MACRO))
    assert got.first()["why_summary"].startswith(
        "Market stress flag is not active. 30d return is directionally moderate."
    )


def test_top_movers_of_nothing(spark):
    nothing = spark.createDataFrame([], MARKET)
    fx_rows, macro = spark.createDataFrame([], FX), spark.createDataFrame([], MACRO)
    assert top_movers_why(nothing, fx_rows, macro).count() == 0


def cross(spark, market, fx_rows, macro):
    return cross_signal_summary(
        spark.createDataFrame(
            [(d, s, c, r, None, f) for d, s, c, r, f in market],
            "snapshot_date date, symbol string, day_change_pct double, return_30d_pct double,"
            " return_90d_pct double, stress_flag boolean",
        ),
        spark.createDataFrame(
            [(d, t, 0.1, None, f) for d, t, f in fx_rows],
            "rate_date date, trend_signal string, daily_change_pct double, return_30d_pct double,"
            " stress_flag boolean",
        ),
        spark.createDataFrame(
            [(c, "i", d, t, 1.0, None) for c, d, t in macro],
            "country_code string, indicator_name string, observation_date date,"
            " trend_direction string, period_change_pct double, year_over_year_pct double",
        ),
    )


@pytest.mark.parametrize(
    ("market", "fx_rows", "macro", "expected"),
    [
        # No FX that day: zero pairs are as weak as strong.
        ([(-5.0, False)], [], [], "stress"),
        ([(-5.0, False)], [("strengthening", False)], [], "elevated"),
        ([(-5.0, False)], [("strengthening", True)], [], "stress"),
        ([(-2.0, False)], [], [], "elevated"),
        ([(1.0, True)], [], [], "elevated"),
        ([(None, False)], [("stable", True)], [], "elevated"),
        ([(1.0, False)], [], ["down"], "elevated"),
        ([(1.0, False)], [("weakening", False)], ["up"], "calm"),
        ([], [("weakening", False)], [], "calm"),
    ],
)
def test_regime(spark, market, fx_rows, macro, expected):
    at = day(0)
    got = cross(
        spark,
        [(at, f"S{i}", 0.0, r, f) for i, (r, f) in enumerate(market)],
        [(at, t, f) for t, f in fx_rows],
        [(f"C{i}", at, t) for i, t in enumerate(macro)],
    )
    assert rows(got, "as_of_date", "risk_regime") == [(at, expected)]


def test_cross_fills_counts_but_not_means(spark):
    got = cross(
        spark,
        [(day(3), "A", 1.0, -6.0, True), (day(3), "B", -1.0, None, False)],
        [(day(1), "weakening", True)],
        [("GBR", day(2), "up")],
    )
    assert got.columns == columns_of("cross_signal_summary")
    first, last = [r.asDict() for r in got.orderBy("as_of_date").collect()]
    assert first["market_symbols_count"] == 0 and first["market_avg_day_change_pct"] is None
    assert first["macro_up_indicators"] == 0 and first["macro_avg_period_change_pct"] is None
    assert first["risk_regime"] == "elevated"
    assert (last["market_symbols_count"], last["market_up_symbols"], last["market_down_symbols"]) == (2, 1, 1)
    assert last["market_avg_return_30d_pct"] == -6.0
    assert (last["fx_weakening_pairs"], last["fx_avg_daily_change_pct"]) == (0, None)
    assert (last["macro_up_indicators"], last["macro_avg_period_change_pct"]) == (1, 1.0)


def test_checks_pass_and_fail(spark):
    data = price_rows("A", [100.0 + i for i in range(95)])
    silver = clean_market(table(spark, "market_prices_raw", data))
    tables = {
        "market_prices": silver,
        "daily_market_snapshot": market_snapshot(silver),
        "cross_signal_summary": empty(spark, "cross_signal_summary"),
    }
    got = {(r["check"], r["subject"]): (r["value"], r["passed"]) for r in checks.run_checks(tables, day(100)).collect()}
    assert got == {
        ("non_empty", "market_prices"): (95, True),
        ("freshness_days", "market_prices"): (6, True),
        ("history_dates", "market_prices"): (95, True),
        ("duplicate_keys", "market_prices"): (0, True),
        ("non_empty", "daily_market_snapshot"): (95, True),
        ("missing_metrics", "daily_market_snapshot"): (0, True),
        ("non_empty", "cross_signal_summary"): (0, False),
        ("freshness_days", "cross_signal_summary"): (None, False),
        ("missing_metrics", "cross_signal_summary"): (0, True),
    }
    with pytest.raises(checks.ValidationError, match=r"non_empty\(cross_signal_summary\) = 0"):
        checks.require_all(checks.run_checks(tables, day(100)))
    tables.pop("cross_signal_summary")
    assert checks.require_all(checks.run_checks(tables, day(100))) == 6


def test_duplicate_keys_and_incomplete_series(spark):
    df = spark.createDataFrame(
        [("a", day(i), None if i == 8 else 1.0) for i in range(9)] + [("b", day(0), None)],
        "symbol string, snapshot_date date, return_7d_pct double",
    )
    assert rows(checks.duplicate_keys(df, ["symbol"])) == [("a", 9)]
    lacking = checks.incomplete_series(df, "symbol", "snapshot_date", {"return_7d_pct": 8})
    assert rows(lacking) == [("a", 9, ["return_7d_pct"])]


def test_measures(spark):
    summary = table(
        spark, "cross_signal_summary",
        [
            (day(i), total, None, None, None, up, 0, 2, 0, 0, None, None, 3, 0, 0, None, None, regime)
            for i, total, up, regime in ((0, 4, 1, "calm"), (1, 8, 6, "stress"))
        ],
    )
    assert measures.headline_measures(summary).first().asDict() == {
        "current_regime": "stress", "stressed_instruments": 2, "market_breadth_pct": 0.75,
        "fx_stressed_pairs": 3,
    }
    no_symbols = summary.withColumn("market_symbols_count", F.lit(0))
    assert measures.headline_measures(no_symbols).first()["market_breadth_pct"] is None

    labels = spark.createDataFrame([(x,) for x in (-20.0, -10.0, -5.0, -4.9, None)], "d double")
    assert [r[0] for r in labels.select(measures.drawdown_label(F.col("d"))).collect()] == [
        "Severe", "Moderate", "Mild", "Near High", "Near High"
    ]

    movers = spark.createDataFrame(
        [(day(0), s, r) for s, r in (("a", -1.0), ("b", 0.0), ("c", None))],
        "as_of_date date, symbol string, return_30d_pct double",
    )
    assert rows(measures.mover_directions(movers).drop("as_of_date")) == [
        ("a", "Down", 1.0), ("b", "Up", 0.0), ("c", "Up", None)
    ]


@pytest.mark.parametrize(
    ("up", "down", "label"),
    [(4, 2, "Expanding"), (3, 2, "Mixed"), (2, 4, "Contracting"), (2, 3, "Mixed"), (0, 0, "Mixed")],
)
def test_macro_consensus(spark, up, down, label):
    trends = ["up"] * up + ["down"] * down + ["flat"]
    data = [(day(1), t) for t in trends] + [(day(0), "up")] * 9
    df = spark.createDataFrame(data, "observation_date date, trend_direction string")
    assert measures.macro_consensus(df).first()["macro_consensus"] == label
