"""Latest rows, long series, as-of aggregates, expressions."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import day, rows
from tidegauge.functions.metrics import any_of, exact_avg, pct_change
from tidegauge.functions.symbols import history_variants, map_ticker, suffix_or_us
from tidegauge.operators.latest import dedupe_latest, latest_rows, top_rows
from tidegauge.operators.series import over_long_series
from tidegauge.plans import checks
from tidegauge.plans.cross import macro_asof_summary

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_dedupe_keeps_latest_then_tiebreak(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 2, 5), ("a", 2, 7), ("b", None, 1), ("b", 0, 2)],
        "k string, t int, v int",
    )
    assert rows(dedupe_latest(df, ["k"], ["t"], ["v"])) == [("a", 2, 7), ("b", 0, 2)]


@FEW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 9)), max_size=12))
def test_dedupe_is_idempotent_and_keeps_every_key(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    once = dedupe_latest(df, ["k"], ["t"], ["v"])
    best = {}
    for k, t, v in data:
        best[k] = max(best.get(k, (t, v)), (t, v))
    assert rows(once) == rows(dedupe_latest(once, ["k"], ["t"], ["v"]))
    assert {r[0]: (r[1], r[2]) for r in rows(once)} == best


def test_dedupe_limits_groups_ahead_of_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe_latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_and_top_rows(spark):
    df = spark.createDataFrame([(day(0), 1), (day(1), 2), (day(1), 3)], "d date, v int")
    assert rows(latest_rows(df, "d"), "v") == [(2,), (3,)]
    assert latest_rows(df.limit(0), "d").count() == 0
    assert rows(top_rows(df, 1, F.col("v").desc()), "v") == [(3,)]


def _naive(df, partition):
    series = Window.partitionBy(*partition).orderBy("t")
    return df.withColumns(
        {
            "back": F.lag("v", 3).over(series),
            "total": F.sum("v").over(series.rowsBetween(-3, 0)),
        }
    )


@pytest.mark.parametrize("block_rows", [3, 7, 64, 4096])
def test_long_series_equal_whole_series_windows(spark, block_rows):
    """Dense, sparse and bursty series, one without a key; blocks of many sizes."""
    pick = random.Random(block_rows)
    start, data = datetime(2024, 1, 1), []
    for key, gap in (("dense", 40), ("sparse", 9000), ("mixed", 1500), (None, 70)):
        at = start
        for i in range(150):
            at += timedelta(seconds=pick.choice([1, gap, gap * (6 if key == "mixed" else 1)]))
            data.append((key, at, i))
    df = spark.createDataFrame(data, "k string, t timestamp, v long")
    slots = [F.date_trunc(unit, "t") for unit in ("hour", "second")]
    split = over_long_series(df, ["k"], ["t"], *slots, 3, _naive, block_rows)
    assert split.columns == ["k", "t", "v", "back", "total"]
    assert rows(split) == rows(_naive(df, ["k"]))


def test_hot_hour_of_one_series_is_cut(spark):
    stamp = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") / 30)
    df = spark.range(100_000).select(F.lit("hot").alias("k"), stamp.alias("t"), F.col("id").alias("v"))
    slots = [F.date_trunc(unit, "t") for unit in ("hour", "second")]
    split = over_long_series(df, ["k"], ["t"], *slots, 3, _naive, 5000)
    wrong = split.filter("v >= 3 AND (back <> v - 3 OR total <> 4 * v - 6)")
    assert split.count() == 100_000 and wrong.count() == 0


@FEW
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.integers(0, 12), st.sampled_from(["up", "down", "flat"]),
                  st.one_of(st.none(), st.integers(-99999, 99999))),
        max_size=15,
        unique_by=lambda o: o[:2],
    )
)
def test_asof_summary_equals_join_with_all_dates(spark, observations):
    schema = (
        "country_code string, indicator_name string, observation_date date,"
        " trend_direction string, period_change_pct double, year_over_year_pct double"
    )
    data = [
        (f"c{s}", "i", day(d), trend, None if v is None else v / 1e4, None if v is None else -v / 1e4)
        for s, d, trend, v in observations
    ]
    dates = [day(n) for n in range(-1, 14, 2)]
    got = rows(
        macro_asof_summary(
            spark.createDataFrame([(d,) for d in dates], "as_of_date date"),
            spark.createDataFrame(data, schema),
        )
    )
    for as_of, up, down, period, yearly in got:
        state = {}
        for row in sorted(data, key=lambda r: r[2]):
            if row[2] <= as_of:
                state[row[0]] = row
        trends = [r[3] for r in state.values()]
        known = [r[4] for r in state.values() if r[4] is not None]
        assert (up, down) == (trends.count("up"), trends.count("down"))
        assert period == (pytest.approx(sum(known) / len(known), abs=1e-9) if known else None)
        assert yearly == (pytest.approx(-sum(known) / len(known), abs=1e-9) if known else None)
    assert [r[0] for r in got] == sorted(dates)


def test_asof_summary_survives_extreme_metrics(spark):
    schema = (
        "country_code string, indicator_name string, observation_date date,"
        " trend_direction string, period_change_pct double, year_over_year_pct double"
    )
    inf, nan = float("inf"), float("nan")
    data = [
        ("a", "i", day(0), "up", inf, 1.0),
        ("a", "i", day(1), "up", 1.0, -inf),
        ("b", "i", day(2), "up", 3e20, nan),
        ("b", "i", day(3), "up", 2.5, inf),
        ("a", "i", day(4), "up", 1.5, 2.0),
        ("b", "i", day(5), "up", 0.5, 4.0),
    ]
    dates = spark.createDataFrame([(day(n),) for n in range(6)], "as_of_date date")
    got = rows(macro_asof_summary(dates, spark.createDataFrame(data, schema)))
    assert [r[3] for r in got] == [inf, 1.0, pytest.approx(1.5e20), 1.75, 2.0, 1.0]
    yearly = [r[4] for r in got]
    assert yearly[:2] == [1.0, -inf] and yearly[2] != yearly[2] and yearly[3] != yearly[3]
    assert yearly[4:] == [inf, 3.0]


def test_pct_change_needs_a_base(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 0.0), (2.0, None), (None, 1.0)], "x double, p double")
    got = [r[0] for r in df.select(pct_change(F.col("x"), F.col("p"), 4)).collect()]
    assert got == [100.0, None, None, None]


def test_any_of_truth_table(spark):
    df = spark.createDataFrame(
        [(a, b) for a in (True, False, None) for b in (True, False, None)], "a boolean, b boolean"
    )
    got = {(r[0], r[1]): r[2] for r in df.select("a", "b", any_of(F.col("a"), F.col("b"))).collect()}
    assert got == {(a, b): a is True or b is True for a, b in got}


def test_exact_avg_ignores_order_and_nulls(spark):
    values = [0.1, 0.2, 0.3, None, 1e6, -1e6]
    for data in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in data], "v double").repartition(3)
        assert df.agg(exact_avg(F.col("v"), 4)).first()[0] == 0.6 / 5
    empty = spark.createDataFrame([(None,)], "v double")
    assert empty.agg(exact_avg(F.col("v"), 4)).first()[0] is None


def test_exact_avg_cuts_no_digits(spark):
    df = spark.createDataFrame([(0.00012345,), (0.00012345,), (None,)], "v double")
    assert df.agg(exact_avg(F.col("v"), 5)).first()[0] == pytest.approx(0.00012345, rel=1e-12)
    rates = df.select(F.col("v").cast("decimal(18,8)").alias("v"))
    assert rates.agg(exact_avg(F.col("v"), 5)).first()[0] == pytest.approx(0.00012345, rel=1e-12)


def test_exact_avg_of_what_does_not_fit(spark):
    inf = float("inf")
    for values in ([inf, 1.0], [1e307, 1e307], [-inf, inf], [float("nan"), 1.0], [1e300, -1e300, 3.0], [2.0**60, 1.0]):
        df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
        got, plain = df.agg(exact_avg(F.col("v"), 2), F.avg("v")).first()
        assert got == plain or (got != got and plain != plain) or got == pytest.approx(sum(values) / len(values))


def test_completeness_ignores_row_order(spark):
    data = [("p", day(n), 1.0) for n in range(40)] + [("p", day(39), None)]
    for rows_ in (data, data[::-1]):
        df = spark.createDataFrame(rows_, "k string, d date, m double").coalesce(1)
        assert checks.incomplete_series(df, "k", "d", {"m": 31}).count() == 0
    late = spark.createDataFrame([*data, ("p", day(40), None)], "k string, d date, m double")
    assert rows(checks.incomplete_series(late, "k", "d", {"m": 31})) == [("p", 42, ["m"])]


def test_symbol_rules(spark):
    symbols = ["VIX.US", "DXY.US", "aapl.us", "SPOT", " A.B.US "]
    df = spark.createDataFrame([(s,) for s in symbols], "s string")
    s = F.col("s")
    got = df.select(map_ticker(s), suffix_or_us(s), history_variants(s)).collect()
    assert [r[0] for r in got] == ["^VIX", "DX-Y.NYB", "AAPL", "SPOT", " A"]
    assert [r[1] for r in got] == ["US", "US", "us", "US", "US "]
    assert [r[2] for r in got] == [
        ["vix.us", "vix"], ["dxy.us", "dxy"], ["aapl.us", "aapl"], ["spot"], ["a.b.us", "a.b", "a"]
    ]
