"""The given tables as landed market, FX, macro and audit data.

Prices and rates get a month-dependent level next to the amounts in the tables,
so that calm, elevated and stress dates all occur. A share of the rows is made
unusable (missing or oversized values, texts that are no dates), and keys repeat,
so the cleaning rules have work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.sources.schemas import columns_of

AS_OF = "2001-11-10"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hours_after(stamp: Column, hours: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(stamp) + hours * 3600)


def _month_distance(stamp: Column) -> Column:
    return F.abs(F.month(stamp) - 6)


def raw_prices(spark: SparkSession, sf_dir: str, symbol: str = "l_suppkey") -> DataFrame:
    shipped = F.col("l_shipdate").cast("timestamp")
    price = 100 + 3 * _month_distance(shipped) + F.col("l_extendedprice") / 50000
    ingested = _hours_after(shipped, F.col("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.col(symbol).cast("string"), F.lit(".US")).alias("symbol"),
        F.when(F.col("l_quantity") == 50, F.lit(None))
        .when((F.col("l_linenumber") == 7) & (F.col("l_discount") == 0), price * 1e10)
        .otherwise(price)
        .alias("price"),
        F.lit("US").alias("currency"),
        shipped.alias("market_time"),
        ingested.alias("ingested_at"),
        F.to_date(ingested).alias("_ingest_date"),
        F.concat(F.lit("feed_"), F.lower("l_returnflag")).alias("_source"),
    )


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = F.col("o_orderdate").cast("timestamp")
    july = F.when(F.month(ordered) == 7, 0.01).otherwise(0.0)
    order_text = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("base_currency"),
        F.col("o_orderpriority").alias("quote_currency"),
        F.when(F.col("o_orderkey") % 101 != 0, 1 + F.col("o_totalprice") / 1e8 + july).alias("rate"),
        ordered.alias("rate_timestamp"),
        F.when(F.col("o_custkey") % 5 != 0, "feed").alias("source_name"),
        F.concat(F.lit("orders/"), order_text).alias("source_url"),
        _hours_after(ordered, F.col("o_orderkey") % 24).alias("ingested_at"),
        order_text.alias("run_id"),
    )


def raw_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = F.col("o_orderdate").cast("timestamp")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    quarter = F.to_date(F.date_trunc("quarter", ordered)).cast("string")
    return (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("country_code"),
            F.col("o_orderpriority").alias("indicator_name"),
            F.when(F.col("o_orderkey") % 89 == 0, F.concat(F.year(ordered).cast("string"), F.lit("Q1")))
            .otherwise(quarter)
            .alias("observation_date"),
            F.when(F.col("o_orderkey") % 97 != 0, F.col("o_totalprice")).alias("observation_value"),
            F.concat(F.lit('{"order": '), F.col("o_orderkey").cast("string"), F.lit("}")).alias(
                "raw_payload"
            ),
            ordered.alias("ingest_ts"),
            F.to_date(ordered).alias("_ingest_date"),
            F.lit("orders").alias("_source"),
        )
        .select(*columns_of("macro_indicators_raw"))
    )


def audit_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("value") > 150
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("pipeline_name"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.get_json_object("props", "$.k").cast("long").alias("row_count"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
        F.col("ts").cast("timestamp").alias("run_timestamp"),
    )
