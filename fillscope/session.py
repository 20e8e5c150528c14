"""Session settings the library is designed for.

Everything here is a public Spark setting; the operators also work on a session
made elsewhere, they only lose the tuning.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

TUNING = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot token, block or trader is split at run time even when the split costs
    # an extra exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A dimension within this size is broadcast, by its files' size or by what a shuffle wrote.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Shuffles start wide and are coalesced to this size, so that they also fit large inputs.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # Input splits of 128 MB keep a task's sort and hash buffers in memory.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def tune(spark: SparkSession, initial_partitions: int | None = None) -> SparkSession:
    """Apply the run-time settings to an existing session.

    ``initial_partitions``: the width at which shuffles start before they are coalesced; about
    the bytes of the largest shuffle over 128 MB.
    """
    if initial_partitions:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fillscope")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in TUNING.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
