"""Managed tables: creation, layout, plain append.

Raw tables are appended to load by load (:mod:`tidegauge.sinks.loads`); Silver, Gold
and states are replaced version by version (:mod:`tidegauge.sinks.versions`). In both
the table's own name is a view, so it never goes away while its rows change.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidegauge.sources.schemas import (
    ALL_TABLES,
    BOOKS,
    INGEST_DAY,
    LAYERS,
    LOAD,
    MONTH,
    MONTH_OF,
    STATES,
    TABLES,
    columns_of,
    qualified,
)
from tidegauge.sources.tables import has_history

#: Rows in a file at most. Files are the unit in which scans are dealt, by bytes and a
#: fixed cost each, so a task reads a few times as many rows, however small rows are stored.
FILE_ROWS = 500_000
#: Partitions that a task writes side by side; beyond that it sorts its rows by partition.
OPEN_FILES = 10


def bootstrap(spark: SparkSession, prefix: str = "") -> None:
    """Create schemas and empty tables that do not exist yet."""
    for layer in LAYERS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{layer}")
    for table in (*BOOKS, *TABLES, *STATES):
        name, columns = qualified(table, prefix), ALL_TABLES[table][1]
        if spark.catalog.tableExists(name):
            continue
        if table in MONTH_OF:
            versioned = f"{name}__v0"
            _create(spark, versioned, f"{columns}, {MONTH} string", MONTH, new_folder(spark, table, prefix))
            spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS SELECT * FROM {versioned}")
        elif TABLES.get(table, ("",))[0] == "bronze":
            _create(spark, loads_of(table, prefix), f"{columns}, {LOAD} string", LOAD, new_folder(spark, table, prefix))
            committed = f"SELECT min(part) FROM {qualified('load_ledger', prefix)} WHERE table_name = '{table}' GROUP BY load_id"
            shown = ", ".join(columns_of(table))
            spark.sql(
                f"CREATE VIEW IF NOT EXISTS {name} AS SELECT {shown} FROM {loads_of(table, prefix)}"
                f" WHERE {LOAD} IN ({committed})"
            )
        else:
            _create(spark, name, columns, None, new_folder(spark, table, prefix))


def _create(spark: SparkSession, name: str, columns: str, by: str | None, folder: str) -> None:
    layout = f" PARTITIONED BY ({by})" if by else ""
    kind = f"parquet OPTIONS (maxRecordsPerFile '{FILE_ROWS}')"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {kind}{layout} LOCATION '{folder}'")


@contextmanager
def _set(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of what runs meanwhile go when it is done.

    Otherwise they stay until the driver happens to collect its garbage, so a job of many
    steps holds the files of all its steps on the executors' disks.
    """
    return _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


@contextmanager
def side_by_side(spark: SparkSession) -> Iterator[None]:
    """Writes of partitioned tables that keep the rows as they come.

    Otherwise a writer sorts its rows by partition, although rebalanced rows are of a
    month or two and a load's rows of one partition. Stamps are written as 64-bit
    numbers, which take less time to write and read than Spark's default of 96 bits;
    pages are packed by zstd, into three quarters of what snappy leaves of Gold.
    """
    settings = {
        "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES),
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    with _set(spark, settings), shuffles_freed(spark):
        yield


def loads_of(table: str, prefix: str = "") -> str:
    """The table under a raw table's name, with the rows of all loads."""
    return f"{qualified(table, prefix)}__loads"


def new_folder(spark: SparkSession, table: str, prefix: str = "") -> str:
    """A folder where the table's layer lies."""
    rows = spark.sql(f"DESCRIBE SCHEMA {prefix}{ALL_TABLES[table][0]}").collect()
    layer = next(r[1] for r in rows if r[0] == "Location").rstrip("/")
    return f"{layer}/{table}-{uuid.uuid4().hex}"


def gathered(df: DataFrame, table: str) -> DataFrame:
    """The rows with the table's month, gathered by partition.

    A rebalance splits partitions that are large and joins small ones, so a hot
    month is written by many tasks and a quiet one makes one file. Raw rows stay
    where they are, in order of their day, so that readers of some days skip row
    groups: a load of many days would make as many small files as folders.
    """
    if table in MONTH_OF:
        column = MONTH_OF[table]
        month = F.col(column) if column == "month" else F.date_format(column, "yyyy-MM")
        return df.withColumn(MONTH, month).hint("rebalance", F.col(MONTH))
    if table in INGEST_DAY:
        return df.sortWithinPartitions(INGEST_DAY[table])
    return df


def counted(df: DataFrame, seen: Observation | None = None, *facts: Column) -> DataFrame:
    """The rows, counted by ``seen`` while they are written."""
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *facts) if seen else df


def append(df: DataFrame, table: str, prefix: str = "") -> None:
    """Append to an audit table or a book, by column name."""
    name = qualified(table, prefix)
    df.select(*df.sparkSession.read.table(name).columns).write.insertInto(name)


def enrich(
    df: DataFrame, source: str | Column, run_id: str | Column, ingested_at: Column | None = None
) -> DataFrame:
    """Add the ingestion columns of a generic raw table."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return df.withColumns(
        {
            "_ingest_timestamp": stamp,
            "_ingest_date": F.to_date(stamp),
            "_source": F.lit(source) if isinstance(source, str) else source,
            "_run_id": F.lit(run_id) if isinstance(run_id, str) else run_id,
        }
    )


class NoData(RuntimeError):
    """A load delivered no rows and there is no history to keep."""


def require_rows(
    spark: SparkSession,
    rows: int,
    table: str,
    keep_history: bool = False,
    explain: Callable[[], str] | None = None,
    prefix: str = "",
) -> str:
    """Message for a load of ``rows`` rows; an empty one passes only with history."""
    if rows:
        return f"{table} loaded"
    if keep_history and has_history(spark, table, prefix):
        return f"{table}: zero records; existing history retained."
    raise NoData(f"{table}: zero records." + (f" {explain()}" if explain else ""))
