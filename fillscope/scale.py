"""Shared building blocks that decide how work is spread over a cluster.

* ``lookup_join`` keeps the large table where adaptive execution can split hot keys.
* ``cut_lineage`` stores an intermediate result reliably, so that several passes
  read it instead of recomputing it, also after an executor is lost.
* ``spread_by_order`` range-partitions rows by a sort key and numbers the
  partitions, the base of running totals and ranks that need no single sorted task.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_stages: list[str] = []
# Deletes the shuffle files of a finished execution, which otherwise stay until the JVM collects its plan.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate results.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="fillscope-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir() or configured


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A path not used before, below the shared folder."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the stored rows.

    Unlike a checkpoint, the stored table is columnar, so later passes read only
    the columns they need, and the optimizer carries no predicates of the cut plan
    along. The shuffle files behind it are deleted once it is written.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "stage")
    _stages.append(path)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession, keep: int = 0) -> int:
    """Delete the stored stages of this process beyond the first ``keep``; call it when nothing reads them any more."""
    dropped = 0
    while len(_stages) > keep:
        path = spark._jvm.org.apache.hadoop.fs.Path(_stages.pop())
        dropped += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return dropped


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """A scope for stored stages: those made inside are deleted at its end, also after an error.

    Results must be written or collected inside the scope, since queries read their stages only then.
    """
    before = len(_stages)
    try:
        yield
    finally:
        drop_stages(spark, before)


def lookup_join(facts: DataFrame, dimension: DataFrame, on: str | Sequence[str] | Column, how: str = "inner") -> DataFrame:
    """Join a large table (kept on the left) with a smaller one.

    Spark broadcasts a dimension whose size is within its thresholds (see
    ``session.TUNING``): file sizes decide while planning, real shuffle sizes at run time. Beyond
    them both sides shuffle; the facts being on the left lets adaptive execution split
    the partitions of hot keys for inner and left joins alike.
    """
    return facts.join(dimension, on, how)


def broadcast_planned(*dimensions: DataFrame) -> bool:
    """Whether Spark broadcasts all these sides by its estimates, which come from file sizes and need no job."""
    most = dimensions[0].sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    sizes = (side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() for side in dimensions)
    return all(int(str(size)) <= most for size in sizes)


def spread_width(spark: SparkSession) -> int:
    """Partitions of a layout whose number the caller leaves open."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread_by_order(
    df: DataFrame, order: Sequence, partitions: int | None = None, name: str = "slice"
) -> DataFrame:
    """Range-partition by ``order`` and number the slices ascending.

    The cut points are sampled, so the numbered rows are stored before use:
    a recomputed partition would otherwise see other cut points. A running number
    breaks ties, so that many equal rows spread over several slices too.
    """
    spark = df.sparkSession
    width = partitions or spread_width(spark)
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(width, *order, F.col("_tie")).drop("_tie")
    return cut_lineage(ranged.withColumn(name, F.spark_partition_id()))


def global_rank(df: DataFrame, order: Sequence, name: str = "rank") -> DataFrame:
    """Number all rows from zero in the given order, without one sorted task.

    The window over the slice sizes holds one row per slice.
    """
    sliced = spread_by_order(df, order, name="_slice")
    earlier = W.partitionBy().orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(W.partitionBy("_slice").orderBy(*order)) - 1
    return (
        sliced.withColumn("_inside", inside)
        .join(starts, "_slice")
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_slice", "_inside", "_start")
    )


# Rows that one task may sort while the place of a row is looked for.
SORTED_ROWS = 1 << 20


def row_at(df: DataFrame, position: int, order: Sequence, sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """The row at a zero-based position of an order, without sorting all rows in one task.

    A range partitioning and the sizes of its slices tell in which slice the position lies. That slice is
    cut again until one task can sort it. Rows that are equal in ``order`` may take each other's
    place. No row beyond the last.
    """
    if position < 0:
        raise ValueError("a position is not negative")
    current, total = df, None
    while total is None or total > sorted_rows:
        sliced = spread_by_order(current, order, name="_slice")
        sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).orderBy("_slice").collect()
        chosen, rest = None, position
        for row in sizes:
            if rest < row.n:
                chosen = row
                break
            rest -= row.n
        if chosen is None:
            return df.limit(0)
        current, position = sliced.where(F.col("_slice") == chosen["_slice"]).drop("_slice"), rest
        total = chosen.n
    return current.orderBy(*order).offset(position).limit(1)
