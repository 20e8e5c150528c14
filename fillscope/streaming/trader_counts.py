"""Trader counts kept up to date by a streaming query.

New trade files are counted in micro-batches; the state is one counter per trader.
The counts are read from the query's own state store, on the executors, so no
batch passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fillscope.operators.subset import trader_counts
from fillscope.scale import shared_folder

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _disk_backed_state(spark: SparkSession) -> Iterator[None]:
    """State on local disk with copies in the checkpoint, unless the session chose.

    Counters of all traders need not fit in executor memory.
    """
    chosen = spark.conf.get(_PROVIDER, None)
    if chosen and "HDFSBacked" not in chosen:
        yield
        return
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if chosen is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, chosen)


def start_counts(trades: DataFrame, checkpoint: str) -> StreamingQuery:
    """Count all files present now; run again on the same folder to continue."""
    with _disk_backed_state(trades.sparkSession):
        return (
            trader_counts(trades)
            .writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def read_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The current counters of a checkpoint."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.trader").alias("trader"), F.col("value.count").alias("total_trades")
    )


def stream_trader_counts(trades: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """Run the streaming query over the available files and return the counts."""
    spark = trades.sparkSession
    folder = checkpoint or shared_folder(spark, "trader-counts")
    start_counts(trades, folder).awaitTermination()
    return read_counts(spark, folder)
