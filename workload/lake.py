"""Raw, Silver and Gold tables over one data folder."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidegauge.plans import jobs
from workload import bindings

RAW = {
    "market_prices_raw": bindings.raw_prices,
    "fx_rates_raw": bindings.raw_rates,
    "macro_indicators_raw": bindings.raw_indicators,
}
BUILDERS = jobs.SILVER | jobs.GOLD


class Lake(Mapping[str, DataFrame]):
    """Tables as plans from the given files on, built as the daily jobs build them.

    Nothing runs while a table is looked up. A query that reads a table several
    times shares its exchanges, which Spark finds equal.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self.built:
            if table in RAW:
                self.built[table] = RAW[table](self.spark, self.sf_dir)
            else:
                inputs, build = BUILDERS[table]
                self.built[table] = build(*[self[name] for name in inputs])
        return self.built[table]

    def __iter__(self):
        return iter([*RAW, *BUILDERS])

    def __len__(self):
        return len(RAW) + len(BUILDERS)
