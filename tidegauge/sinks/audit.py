"""One audit row per run of a job."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Observation, SparkSession

from tidegauge.sinks.tables import append
from tidegauge.sources.schemas import TABLES

log = logging.getLogger(__name__)


def log_run(
    spark: SparkSession, name: str, status: str, row_count: int | None, message: str | None = None, prefix: str = ""
) -> None:
    row = (name, status, row_count, message, datetime.now(timezone.utc))
    append(spark.createDataFrame([row], TABLES["pipeline_runs"][1]), "pipeline_runs", prefix)


def try_log_run(
    spark: SparkSession, name: str, status: str, row_count: int | None, message: str | None = None, prefix: str = ""
) -> None:
    """As :func:`log_run`; a failing audit table must not fail the job."""
    try:
        log_run(spark, name, status, row_count, message, prefix)
    except Exception as error:
        log.warning("audit row for %s skipped: %s", name, error)


def write_counted(write: Callable[[Observation], None]) -> int:
    """Write a table and return its row count, counted while it is written."""
    seen = Observation()
    write(seen)
    return seen.get["rows"]


def audited(spark: SparkSession, name: str, run: Callable[[], int], prefix: str = "") -> int:
    """Run a job that returns its row count and record how it went."""
    try:
        rows = run()
    except Exception as error:
        try_log_run(spark, name, "FAILED", 0, str(error), prefix)
        raise
    try_log_run(spark, name, "SUCCESS", rows, f"{name} completed", prefix)
    return rows
