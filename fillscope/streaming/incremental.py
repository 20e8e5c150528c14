"""Incremental load of trade files, exactly once, with counts kept beside the rows.

A streaming query hands over new files in micro-batches. A batch writes its rows and its counts per trader under
its own key, replacing what an interrupted attempt left, and then commits: one small ledger file
names the key and its source files. Readers see committed keys only. A replayed batch finds its key and
writes the same again; a query that starts over with a new checkpoint finds its files in the ledger and leaves them out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillscope.operators.subset import trader_counts

LEDGER = "load string, source string"
_SOURCE = "_source_file"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or no rows where nothing was stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """Committed loads and the files each of them took: (load, source)."""
    return _read(spark, f"{target}/ledger", LEDGER)


def load_batch(batch: DataFrame, load: str, target: str, derive: Callable[[DataFrame], DataFrame]) -> None:
    """Store one batch under its key. ``batch`` has the column ``_source_file``; ``derive`` makes trades of the rest.

    Files that an earlier load took are left out, so that only a batch's own files count as its own.
    """
    spark = batch.sparkSession
    taken = ledger(spark, target).where(F.col("load") != load).select("source").distinct()
    fresh = batch.join(taken, batch[_SOURCE] == taken["source"], "left_anti")
    trades = derive(fresh.drop(_SOURCE))
    trades.write.mode("overwrite").parquet(f"{target}/rows/load={load}")
    stored = spark.read.schema(trades.schema).parquet(f"{target}/rows/load={load}")
    trader_counts(stored).write.mode("overwrite").parquet(f"{target}/counts/load={load}")
    # The commit: written last, one file per key.
    files = fresh.select(F.lit(load).alias("load"), F.col(_SOURCE).alias("source")).distinct()
    files.coalesce(1).write.mode("overwrite").parquet(f"{target}/ledger/part={load}")


def load_files(
    stream: DataFrame, target: str, checkpoint: str, derive: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> None:
    """Load all files that are there now; run again to continue. ``stream`` reads files."""
    named = stream.select("*", F.col("_metadata.file_path").alias(_SOURCE))

    def write(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_batch(batch, f"{query}-{number}", target, derive)

    (
        named.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _committed(spark: SparkSession, target: str, part: str, schema: str) -> DataFrame:
    """Rows of the committed loads; keys that were never committed are not read."""
    stored = _read(spark, f"{target}/{part}", f"{schema}, load string")
    # One row per load: the partitions they name are the only ones to be read.
    loads = ledger(spark, target).select("load").distinct()
    return stored.join(loads, "load", "left_semi").drop("load")


def loaded_trades(spark: SparkSession, target: str, schema: str) -> DataFrame:
    return _committed(spark, target, "rows", schema)


def loaded_counts(spark: SparkSession, target: str) -> DataFrame:
    """Trades per trader over all loads, from the counts stored with each."""
    parts = _committed(spark, target, "counts", "trader string, total_trades bigint")
    return parts.groupBy("trader").agg(F.sum("total_trades").alias("total_trades"))
