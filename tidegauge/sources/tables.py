"""Scans and empty frames by table name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidegauge.sources.schemas import ALL_TABLES, TABLES, columns_of, qualified


def scan(spark: SparkSession, table: str, prefix: str = "") -> DataFrame:
    """The table with the columns of its contract."""
    return spark.read.table(qualified(table, prefix)).select(*columns_of(table))


class Catalog(Mapping[str, DataFrame]):
    """The written tables, Gold with its month: readers of the newest date
    (:func:`tidegauge.operators.latest.latest_rows`) read one month's files."""

    def __init__(self, spark: SparkSession, prefix: str = ""):
        self.spark, self.prefix = spark, prefix

    def __getitem__(self, table: str) -> DataFrame:
        return self.spark.read.table(qualified(table, self.prefix))

    def __iter__(self):
        return iter(TABLES)

    def __len__(self):
        return len(TABLES)


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A typed frame without rows."""
    return spark.createDataFrame([], ALL_TABLES[table][1])


def has_history(spark: SparkSession, table: str, prefix: str = "") -> bool:
    """Whether the table exists and holds a row."""
    name = qualified(table, prefix)
    return spark.catalog.tableExists(name) and not spark.read.table(name).isEmpty()
