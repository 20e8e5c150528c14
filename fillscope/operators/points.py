"""Rows for a scatter plot: normalization, filtering, thinning and axis profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillscope.functions.categories import decode_one_hot
from fillscope.functions.numeric import is_finite
from fillscope.schemas import BUYS_ONLY, DEFAULT_CATEGORY, FLAG_COLUMNS, MEASURES

# Fields plotted as logs, fields plotted through asinh, fields never
# on a log axis, and the range ratio from which an axis turns logarithmic.
LOG_FIELDS = ("avg_trade_size", "total_trade_volume", "total_trade_number", "frequency")
ASINH_FIELDS = ("net_gains_loss", "profit_per_trade")
LINEAR_FIELDS = ("avg_odds", "proj_1", "proj_2")
LOG_RATIO = 50.0
POINT_RANGE = (1000, 5000)
HEAD_SHARE = 0.7
SAMPLE_SEED = 42


def _positive_log(value: Column) -> Column:
    return F.when(value > 0, F.ln(value.cast("double")))


def plot_rows(clustered: DataFrame) -> DataFrame:
    """Plot values per trader: logs of size, volume, count and frequency, others raw.

    Each measure comes twice, over all trades and over buys only.
    """
    values = []
    for suffix in ("", BUYS_ONLY):
        for name in MEASURES:
            raw = F.col(name + suffix)
            values.append((_positive_log(raw) if name in LOG_FIELDS else raw).alias(name + suffix))
    present = [name for name in FLAG_COLUMNS if name in clustered.columns]
    extra = [
        c for c in ("proj_1", "proj_2", "kmeans_cluster") if c in clustered.columns
    ]
    return clustered.select(
        "trader", *values, decode_one_hot(present).alias("category"), *present, *extra
    )


def _in_category(rows: DataFrame, category: str) -> Column:
    flags = {name: F.coalesce(F.col(f"`{name}`"), F.lit(False)) for name in FLAG_COLUMNS if name in rows.columns}
    wanted = flags.get(f"category_{category}", F.lit(False))
    if category == DEFAULT_CATEGORY:
        others = F.lit(False)
        for name, flag in flags.items():
            if name != f"category_{category}":
                others = others | flag
        return wanted | ~others
    return wanted


def thin_points(
    rows: DataFrame,
    max_points: int = POINT_RANGE[1],
    min_trades: int = 1,
    category: str | None = None,
    x_field: str = "proj_1",
    y_field: str = "proj_2",
    include_sales: bool = False,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """At most ``max_points`` rows: the most active traders, then a seeded sample.

    Both parts are bounded top-k queries. The radius is scaled by the largest
    volume among the kept points.
    """
    low, high = POINT_RANGE
    budget = max(low, min(high, max_points))
    head_size = int(budget * HEAD_SHARE)
    suffix = "" if include_sales else BUYS_ONLY

    def field(name: str) -> Column:
        return F.col(name + suffix) if name in MEASURES else F.col(name)

    number, volume = field("total_trade_number"), field("total_trade_volume")
    kept = rows.filter(is_finite(number) & (F.rint(F.exp(number)) >= max(1, min_trades)))
    kept = kept.filter(is_finite(field(x_field)) & is_finite(field(y_field)))
    if category:
        kept = kept.filter(_in_category(rows, category))
    busiest = [number.desc(), volume.desc_nulls_last(), F.col("trader").asc()]
    head = kept.orderBy(*busiest).limit(head_size)
    draw = F.md5(F.concat(F.col("trader"), F.lit(f":{seed}")))
    # The head is at most a few thousand keys, a proven bound for a broadcast.
    rest = kept.join(F.broadcast(head.select("trader")), "trader", "left_anti")
    tail = rest.orderBy(draw, "trader").limit(budget - head_size)
    points = head.withColumn("part", F.lit("head")).unionByName(tail.withColumn("part", F.lit("tail")))
    size = F.coalesce(F.exp(volume), F.lit(0.0))
    # At most max_points rows pass through this window.
    largest = F.greatest(F.lit(1.0), F.max(size).over(W.partitionBy()))
    return points.withColumn("radius", F.lit(2.0) + 6.0 * F.sqrt(F.greatest(F.lit(0.0), size) / largest))


def axis_profile(
    rows: DataFrame, fields: Sequence[str] = MEASURES, include_sales: bool = False
) -> DataFrame:
    """Range of each plot field over all rows and whether its axis is logarithmic."""
    suffix = "" if include_sales else BUYS_ONLY

    def plotted(name: str) -> Column:
        value = (F.col(name + suffix) if name in MEASURES else F.col(name)).cast("double")
        value = F.when(is_finite(value), value)
        return F.asinh(value) if name in ASINH_FIELDS else value

    pairs = F.array(
        *[F.struct(F.lit(name).alias("field"), plotted(name).alias("value")) for name in fields]
    )
    ranges = (
        rows.select(F.inline(pairs))
        .groupBy("field")
        .agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"))
    )
    ratio = F.when(F.col("min_value") > 0, F.col("max_value") / F.col("min_value"))
    never = F.col("field").isin(*LINEAR_FIELDS, *ASINH_FIELDS)
    return ranges.withColumns(
        {
            "ratio": ratio,
            "use_log": F.coalesce(~never & (ratio >= LOG_RATIO), F.lit(False)),
            "use_asinh": F.col("field").isin(*ASINH_FIELDS),
        }
    )
