"""Session settings the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes the shuffles, splits skewed join partitions and turns joins with a
# small measured side into broadcasts. Splitting a hot join key must win even
# where it costs one more exchange above the join.
# Parquet files of keys and amounts grow some ten times when they are read into rows: scans are
# cut small, so that the sort each task does before a shuffle (``dedup.latest_by``) stays in memory.
# Shuffled keys are packed as tightly: 64 MB of them are ten million rows, too many for one task.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session (all are runtime settings)."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, app: str = "ledgerloom", **extra: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
