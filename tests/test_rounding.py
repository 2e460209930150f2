"""Rounding by whole units."""

from __future__ import annotations

import math
import random
import struct

from pyspark.sql import functions as F

from helpers import price_rows
from tidegauge.functions.metrics import rounded
from tidegauge.plans.market import market_snapshot
from tidegauge.plans.silver import clean_market
from tidegauge.sources.schemas import TABLES


def _values() -> list[float | None]:
    odd = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1e300, -1e300, 5e-324, 1e9, 1e5, 123456.78905, -123456.78905]
    ties = [n / 10 + 0.05 * 10**-d for n in range(-30, 30) for d in range(8)]
    near = [math.nextafter(x, to) for x in ties for to in (math.inf, -math.inf)]
    drawn = random.Random(7)
    spread = [drawn.uniform(-1, 1) * 10 ** drawn.uniform(-9, 18) for _ in range(4000)]
    return odd + ties + near + [round(x, 5) for x in spread] + spread


def test_rounded_equals_round_to_the_last_bit(spark):
    given = spark.createDataFrame([(v,) for v in _values()], "v double")
    for digits in (4, 6):
        pairs = given.select("v", rounded(F.col("v"), digits).alias("ours"), F.round("v", digits).alias("plain")).collect()
        for v, ours, plain in pairs:
            assert (ours is None) == (plain is None), v
            if plain is not None:
                same = struct.pack("<d", ours) == struct.pack("<d", plain)
                assert same or (math.isnan(ours) and math.isnan(plain)), (v, digits, ours, plain)


def test_snapshot_rounds_by_units(spark):
    raw = spark.createDataFrame(price_rows("A", [100.0 + i for i in range(35)]), TABLES["market_prices_raw"][1])
    plan = market_snapshot(clean_market(raw))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rint((day_change_pct" in plan and "rint((drawdown_from_90d_high_pct" in plan
