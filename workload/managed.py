"""The daily jobs over managed tables, in schemas of their own, read back.

Each set of tables has a prefix that nobody else knows, so no query touches a table
that it did not create, and is built once per session and data folder.
"""

from __future__ import annotations

import contextlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.plans import incremental, jobs
from tidegauge.plans.checks import ValidationError
from tidegauge.sinks import loads
from tidegauge.sinks.export import export_json, export_parquet
from tidegauge.sinks.tables import NoData, bootstrap
from tidegauge.sinks.versions import current_version, read_version
from tidegauge.sources.schemas import columns_of
from tidegauge.sources.tables import Catalog, empty, scan
from workload import bindings, payloads
from workload.bindings import AS_OF
from workload.lake import RAW

HISTORY_RANGE = ("1996-01-01", "2000-12-31")
INPUTS = ("lineitem", "orders", "customer", "nation", "part")

_built: dict[tuple, str] = {}
_lock = threading.Lock()


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """What tells one state of the data folder from another."""
    facts = ("_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size")
    return tuple(tuple(bindings.table(spark, sf_dir, name).select(*facts).first() or ()) for name in INPUTS)


def once(spark: SparkSession, sf_dir: str, build: Callable[[SparkSession, str, str], None]) -> str:
    """The prefix of tables that ``build`` makes, made anew where the folder changed."""
    key = (spark.sparkContext.applicationId, sf_dir, build.__name__, _stamp(spark, sf_dir))
    with _lock:
        if key not in _built:
            prefix = f"{build.__name__}_{uuid.uuid4().hex[:12]}_"
            bootstrap(spark, prefix)
            build(spark, sf_dir, prefix)
            _built[key] = prefix
        return _built[key]


def daily(spark: SparkSession, sf_dir: str, prefix: str) -> None:
    """All raw tables loaded, all Silver and Gold tables built."""
    for table, raw in RAW.items():
        jobs.ingest(raw(spark, sf_dir), table, load_id="all", prefix=prefix)
    jobs.rebuild_silver(spark, prefix)
    jobs.rebuild_gold(spark, prefix)


def tables(spark: SparkSession, sf_dir: str) -> Catalog:
    """The tables that the daily jobs have written."""
    return Catalog(spark, once(spark, sf_dir, daily))


FX_SILVER = {"fx_rates": jobs.SILVER["fx_rates"]}
FX_GOLD = {"fx_trend_signals": jobs.GOLD["fx_trend_signals"]}


def replayed(spark: SparkSession, sf_dir: str, prefix: str) -> None:
    """Rates landed twice and the FX domain built; empty loads with and without history,
    and a validation that fails."""
    raw = bindings.raw_rates(spark, sf_dir)
    jobs.ingest(raw, "fx_rates_raw", prefix=prefix)
    jobs.ingest(raw, "fx_rates_raw", note="again", prefix=prefix)
    jobs.rebuild(spark, "silver", FX_SILVER, prefix)
    jobs.rebuild(spark, "gold", FX_GOLD, prefix)
    jobs.ingest(empty(spark, "fx_rates_raw"), "fx_rates_raw", keep_history=True, prefix=prefix)
    with contextlib.suppress(NoData):
        jobs.ingest(empty(spark, "macro_indicators_raw"), "macro_indicators_raw", keep_history=True, prefix=prefix)
    with contextlib.suppress(ValidationError):
        jobs.validate(spark, AS_OF, prefix)


def managed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a replay: copies in the raw table change nothing."""
    return scan(spark, "fx_rates", once(spark, sf_dir, replayed))


def managed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit table of those jobs."""
    runs = scan(spark, "pipeline_runs", once(spark, sf_dir, replayed))
    return runs.groupBy("pipeline_name", "status", "row_count").agg(F.count(F.lit(1)).alias("runs"))


def exported_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON export's rows, next to whether the Parquet export has them too."""
    prefix = once(spark, sf_dir, replayed)
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    folder = f"{warehouse}/exports/{uuid.uuid4().hex}"
    # Stamps with a fraction of a second, which no row of the tables has.
    stamp = F.timestamp_micros(F.unix_micros("ingested_at") + 678901)
    signals = scan(spark, "fx_trend_signals", prefix).withColumn("ingested_at", stamp)
    export_parquet(signals, f"{folder}/parquet")
    export_json(signals, f"{folder}/json", "rate_date", AS_OF)
    kinds = {"date": "string", "timestamp": "string"}
    schema = ", ".join(f"{name} {kinds.get(kind, kind)}" for name, kind in signals.dtypes)
    told = spark.read.schema(schema).json(f"{folder}/json")
    held = spark.read.parquet(f"{folder}/parquet")
    per_pair = held.groupBy("currency_pair").agg(F.count(F.lit(1)).alias("parquet_rows"))
    return told.join(per_pair, "currency_pair", "left")


# Months whose rows come in part late, and one that comes twice.
DELAYED = ("1995-03", "1997-11", "2001-06", "2001-07", "2001-08", "2001-09", "2001-10", "2001-11")
REPEATED = "1995-03"
STAMPS = {"market_prices_raw": "market_time", "fx_rates_raw": "rate_timestamp"}


def late(raw: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """The rows of a first load and of a second: late ones, newer ones of keys that the
    first has, and some that it has as well."""
    text = F.date_format(STAMPS[table], "yyyy-MM") if table in STAMPS else F.substring("observation_date", 1, 7)
    month = F.coalesce(text, F.lit(""))
    stamp = F.col("ingest_ts" if "ingest_ts" in raw.columns else "ingested_at")
    delayed = month.isin(list(DELAYED)) & (F.pmod(F.xxhash64(stamp), F.lit(3)) > 0)
    return raw.filter(~delayed), raw.filter(delayed | (month == REPEATED))


def incremental_lake(spark: SparkSession, sf_dir: str, prefix: str) -> None:
    """A first load and a full build, then a second load and an update."""
    split = {table: late(raw(spark, sf_dir), table) for table, raw in RAW.items()}
    for table, (first, _) in split.items():
        jobs.ingest(first, table, load_id="first", prefix=prefix)
    incremental.full_build(spark, prefix)
    for table, (_, second) in split.items():
        jobs.ingest(second, table, load_id="second", prefix=prefix)
    incremental.update(spark, prefix)


def updated(table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: scan(spark, table, once(spark, sf_dir, incremental_lake))


def from_states(build: Callable[[Catalog], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A report over states that an update has brought up to date."""
    return lambda spark, sf_dir: build(Catalog(spark, once(spark, sf_dir, incremental_lake)))


def booked_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rates after a load that was lost ahead of the ledger, run again, and run once
    more by somebody who did not hear that it was done."""
    return scan(spark, "fx_rates_raw", once(spark, sf_dir, retried)).drop("source_url", "run_id")


def retried(spark: SparkSession, sf_dir: str, prefix: str) -> None:
    raw = bindings.raw_rates(spark, sf_dir)
    # The rows of an attempt that was lost before it was booked.
    part, name = "day-1.lost", loads.loads_of("fx_rates_raw", prefix)
    lost = raw.select(*columns_of("fx_rates_raw")).withColumn("_load", F.lit(part))
    lost.select(*spark.read.table(name).columns).write.insertInto(name)
    for _ in range(2):
        jobs.ingest(raw, "fx_rates_raw", load_id="day-1", prefix=prefix)


def versioned_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rates per pair in a version and in the one that replaced it."""
    prefix = once(spark, sf_dir, replaced)
    last = current_version(spark, "fx_rates", prefix)
    found = [
        read_version(spark, "fx_rates", version, prefix)
        .groupBy("currency_pair")
        .agg(F.count(F.lit(1)).alias("rates"), F.max("rate_timestamp").alias("newest"))
        .withColumn("version", F.lit(label))
        for label, version in (("before", last - 1), ("after", last))
    ]
    return found[0].unionByName(found[1])


SPLIT = "1998-06-01"


def replaced(spark: SparkSession, sf_dir: str, prefix: str) -> None:
    raw = bindings.raw_rates(spark, sf_dir)
    newer = F.col("rate_timestamp") >= F.lit(SPLIT).cast("timestamp")
    for rows in (raw.filter(~newer), raw.filter(newer)):
        jobs.ingest(rows, "fx_rates_raw", prefix=prefix)
        jobs.rebuild(spark, "silver", FX_SILVER, prefix)


def backfilled(spark: SparkSession, sf_dir: str, prefix: str) -> None:
    landed = (
        payloads.requested_symbols(spark, sf_dir),
        payloads.landed_history(spark, sf_dir),
        payloads.landed_snapshots(spark, sf_dir),
    )
    jobs.backfill(*landed, *HISTORY_RANGE, prefix=prefix, ingested_at=payloads.loaded_at())


def backfilled_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table after a backfill of the best source per symbol."""
    return scan(spark, "market_prices_raw", once(spark, sf_dir, backfilled))
