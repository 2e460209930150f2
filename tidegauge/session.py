"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Needed for right results or for plans that survive skew. Sizing settings
# (executors, memory, shuffle partitions) stay with whoever owns the cluster.
RUNTIME_CONF = {
    # FX and candle stamps are UTC midnights; any other zone moves their date.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Run-time coalescing, size-checked broadcasts and skew-join splitting.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# What a task takes at most, in bytes as they are stored. Sorted Parquet and shuffle rows
# take a few bytes a row, and unpack to twenty times as many in a sort, so the default
# sizes spill as soon as a table is large enough to fill them. Lower settings stay.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20,
}

# Parts that a shuffle is cut into before small ones are joined to the size above. With as
# many as there are cores, or any number near it, a part and the task that sorts it grow with
# the input: nothing splits parts that a window or an aggregate needs whole. Higher settings
# stay. Beyond 2000 the driver keeps only average sizes.
SHUFFLE_PARTS, PARTS_KEY = 1024, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in TASK_BYTES.items():
        if as_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    held = spark.conf.get(PARTS_KEY, None) or spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(PARTS_KEY, str(max(int(held), SHUFFLE_PARTS)))
    return spark


def local_session(cores: int | str = 8, app: str = "tidegauge") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    return configure(spark)
