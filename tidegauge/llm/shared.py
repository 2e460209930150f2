"""Tables that several jobs share, in the folder that every executor reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partition_by: str, **options: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: it cuts the lineage and
    outlives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As :func:`written`, in buckets of ``key``: joins by it read them in place.

    The frame comes partitioned by ``key`` into as many parts.
    """
    spark = df.sparkSession
    title = f"{name}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", "zstd").option("path", fresh_path(spark, name))
    writer.bucketBy(buckets, key).saveAsTable(title)
    return spark.table(title)
