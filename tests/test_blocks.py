"""As-of rows, long frames and merged distinct counts against plain versions."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from statistics import stdev

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.asof_rows import asof_rows
from tidegauge.operators.distincts import bitmap_states, distinct_counts, extend_dictionary, merge_states
from tidegauge.operators.long_frames import deviation_of_state, mean_of_state, moving_state
from tidegauge.plans.coverage import coverage_report, coverage_states, replace_months

START = datetime(2024, 1, 1)


def _times(rng, n):
    # One hour holds most rows, and times repeat.
    return [START + timedelta(minutes=rng.choice([rng.randrange(40), rng.randrange(4000)])) for _ in range(n)]


@pytest.mark.parametrize("block_rows", [3, 16, 4096])
def test_asof_rows_equal_brute_force(spark, block_rows):
    rng = random.Random(block_rows)
    keys = ["hot", "hot", "hot", "cold", None]
    left = [(rng.choice(keys), t, i) for i, t in enumerate(_times(rng, 150))]
    left += [("hot", None, 900), ("alone", START, 901)]
    right = [(rng.choice(keys), t, rng.choice("abc"), rng.choice([None, 1.0, 2.0])) for t in _times(rng, 60)]
    right += [("hot", None, "z", 5.0)]

    def found(key, time):
        rows = [r for r in right if time and r[1] and r[0] == key and r[1] <= time]
        best = max(rows, key=lambda r: (r[1], r[2], r[3] is not None, r[3] or 0), default=None)
        return best[1:] if best else (None, None, None)

    got = asof_rows(
        spark.createDataFrame(left, "k string, asked timestamp, i int"),
        spark.createDataFrame(right, "k string, told timestamp, who string, v double"),
        ["k"], "asked", "told", ["who"], block_rows,
    )
    assert got.columns == ["k", "asked", "i", "told", "who", "v"]
    expected = {i: (k, t, i, *found(k, t)) for k, t, i in left}
    assert {r["i"]: tuple(r) for r in got.collect()} == expected


def test_asof_rows_of_empty_sides(spark):
    left = spark.createDataFrame([("a", START)], "k string, asked timestamp")
    right = spark.createDataFrame([("a", START, 1)], "k string, told timestamp, v int")
    assert asof_rows(left.limit(0), right, ["k"], "asked", "told").count() == 0
    assert [tuple(r) for r in asof_rows(left, right.limit(0), ["k"], "asked", "told").collect()] == [("a", START, None, None)]


@pytest.mark.parametrize("rows, block_rows", [(9, 8), (10, 8), (16, 8), (17, 8), (18, 8), (50, 7), (1000, 64), (10_000, 4096)])
def test_long_frames_equal_plain_frames(spark, rows, block_rows):
    rng = random.Random(rows)
    lengths = {"hot": 15_000 if rows == 10_000 else 300, "cold": 5, None: 40}
    data = [
        (k, START + timedelta(minutes=i), None if rng.random() < 0.1 else round(rng.uniform(-3, 3), 4))
        for k, n in lengths.items()
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "k string, t timestamp, v double")
    got = moving_state(
        df, ["k"], ["t"], F.date_trunc("hour", "t"), F.date_trunc("second", "t"), F.col("v"), 4, rows, block_rows
    ).withColumns({"mean": mean_of_state(4), "deviation": deviation_of_state(4)})
    found = {(r["k"], r["t"]): r for r in got.collect()}
    assert len(found) == len(data)
    for k, n in lengths.items():
        values = [v for key, _, v in data if key == k]
        for i in range(0, n, 1 if n < 1000 else 977):
            frame = [v for v in values[max(0, i - rows + 1) : i + 1] if v is not None]
            units = [round(v * 10_000) for v in frame]
            r = found[k, START + timedelta(minutes=i)]
            assert (r["frame_n"], int(r["frame_sum"]), int(r["frame_squares"])) == (len(units), sum(units), sum(u * u for u in units))
            assert (r["frame_high"], r["frame_low"]) == (max(units, default=None), min(units, default=None))
            assert r["mean"] == (pytest.approx(sum(frame) / len(frame)) if frame else None)
            assert r["deviation"] == (pytest.approx(stdev(frame)) if len(frame) > 1 else None)


def test_short_frames_are_refused(spark):
    df = spark.createDataFrame([("a", START, 1.0)], "k string, t timestamp, v double")
    with pytest.raises(ValueError):
        moving_state(df, ["k"], ["t"], F.col("t"), F.col("t"), F.col("v"), 4, 8, 8)


def test_dictionary_keeps_numbers_and_stays_exact(spark):
    first = spark.createDataFrame([(f"k{i % 3000}",) for i in range(6000)] + [(None,)], "k string")
    more = spark.createDataFrame([(f"k{i}",) for i in range(2000, 5000)], "k string")
    known = extend_dictionary(first, "k")
    numbers = {r["k"]: r["number"] for r in known.collect()}
    grown = {r["k"]: r["number"] for r in extend_dictionary(more, "k", known).collect()}
    assert len(numbers) == 3000 and len(grown) == 5000
    assert len(set(grown.values())) == 5000 and max(grown.values()) < 5000 * 4
    assert all(grown[k] == n for k, n in numbers.items())


def test_bitmaps_merge_to_exact_counts(spark):
    rng = random.Random(5)
    data = [(rng.randrange(6), rng.choice([None, rng.randrange(100), rng.randrange(200_000)])) for _ in range(3000)]
    months = bitmap_states(spark.createDataFrame(data, "month int, n long"), ["month"], F.col("n"))
    halves = merge_states(months, [(F.col("month") / 3).cast("int").alias("half")])

    def exact(group):
        return {g: len({n for m, n in data if n is not None and group(m) == g}) for g in {group(m) for m, _ in data}}

    assert {r[0]: r[1] for r in distinct_counts(months, ["month"], "d").collect()} == exact(lambda m: m)
    assert {r[0]: r[1] for r in distinct_counts(halves, ["half"], "d").collect()} == exact(lambda m: m // 3)


def test_coverage_keeps_untouched_months(spark):
    rng = random.Random(3)

    def daily(n):
        rows = {(f"s{rng.randrange(40)}", (START + timedelta(days=rng.randrange(500))).date()) for _ in range(n)}
        return sorted(rows)

    def frame(data):
        return spark.createDataFrame(data, "symbol string, day date")

    def exact(data):
        groups = {}
        for s, d in data:
            for at in (("month", d.strftime("%Y-%m")), ("year", d.strftime("%Y")), ("all", "all")):
                groups.setdefault(at, []).append((s, d))
        return {(*at, len({s for s, _ in g}), len({d for _, d in g})) for at, g in groups.items()}

    old, late = daily(300), [("new", (START + timedelta(days=70)).date()), ("s1", (START + timedelta(days=71)).date())]
    known = extend_dictionary(frame(old), "symbol")
    states = coverage_states(frame(old), "symbol", "day", known)
    assert {tuple(r) for r in coverage_report(states).collect()} == exact(old)
    grown = extend_dictionary(frame(late), "symbol", known)
    march = [r for r in sorted({*old, *late}) if (r[1].year, r[1].month) == (2024, 3)]
    months = spark.createDataFrame([(START.date().replace(month=3),)], "month date")
    updated = replace_months(states, coverage_states(frame(march), "symbol", "day", grown), months)
    assert {tuple(r) for r in coverage_report(updated).collect()} == exact([*old, *late])
    assert coverage_report(states.limit(0)).count() == 0
