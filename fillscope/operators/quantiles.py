"""Exact medians per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillscope.scale import cut_lineage

CUTS = 64
# Groups up to which their cut points, a few hundred bytes each, are broadcast.
BROADCAST_GROUPS = 10_000


def exact_medians(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """The exact median of ``value`` per ``keys``, NULL values ignored.

    1. Equal values are counted once, so a frequent value is a single row.
    2. An approximate quantile sketch of bounded size, merged from partial sketches,
       cuts each group into about ``CUTS`` ordered buckets.
    3. Bucket sizes tell which bucket holds the middle ranks.
    4. Only that bucket, about one part in ``CUTS`` of the group's distinct values,
       is ranked.

    ``df`` is read by two branches; store it first if it is costly. The counted values and the
    cut points are stored. Cut points of up to ``BROADCAST_GROUPS`` groups are broadcast, so
    that no value moves to its group.
    """
    keys = list(keys)
    cells = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = cut_lineage(cells)
    steps = [position / CUTS for position in range(1, CUTS)]
    sketch = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.percentile_approx(F.col(value).cast("double"), steps, 10_000).alias("cuts"),
        F.count(F.lit(1)).alias("total"),
    )
    sketch = cut_lineage(sketch)
    few = sketch.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    placed = cells.join(F.broadcast(sketch) if few else sketch, keys).select(
        *keys,
        "value",
        "n",
        F.expr("size(filter(cuts, cut -> cut < value))").alias("bucket"),
        F.floor((F.col("total") - 1) / 2).alias("low_rank"),
        F.floor(F.col("total") / 2).alias("high_rank"),
    )
    sizes = placed.groupBy(*keys, "bucket").agg(F.sum("n").alias("bucket_n"))
    earlier = W.partitionBy(*keys).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("bucket_start", F.coalesce(F.sum("bucket_n").over(earlier), F.lit(0)))
    starts = cut_lineage(starts)
    middle = placed.join(F.broadcast(starts) if few else starts, [*keys, "bucket"]).filter(
        (F.col("low_rank") < F.col("bucket_start") + F.col("bucket_n"))
        & (F.col("high_rank") >= F.col("bucket_start"))
    )
    below = W.partitionBy(*keys, "bucket").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    first = F.col("bucket_start") + F.coalesce(F.sum("n").over(below), F.lit(0))
    ranked = middle.withColumn("first_rank", first)

    def at(rank: str):
        holds = (F.col(rank) >= F.col("first_rank")) & (F.col(rank) < F.col("first_rank") + F.col("n"))
        return F.max(F.when(holds, F.col("value")))

    return ranked.groupBy(*keys).agg(((at("low_rank") + at("high_rank")) / 2).alias(name))
