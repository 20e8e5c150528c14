"""k-means clusters, cluster reports and the cluster legend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillscope.functions.numeric import half_even
from fillscope.operators import kmeans
from fillscope.operators.features import NUMERIC_FEATURES
from fillscope.operators.quantiles import exact_medians
from fillscope.scale import cut_lineage
from fillscope.schemas import BUYS_ONLY

CLUSTERS = 7
FIRST_SEED = 42
STARTS = 20
# Movement of the centres below which a start rests: the square root of 1e-4
# times the mean variance of standardized features next to six flags.
TOLERANCE = 0.0075


def fit_kmeans(
    vectors: DataFrame, k: int = CLUSTERS, starts: int = STARTS, seed: int = FIRST_SEED
) -> kmeans.Clustering | None:
    """The clustering of least cost over several starts, which share their passes over the rows."""
    return kmeans.fit(kmeans.stored_rows(vectors), k, starts, seed, TOLERANCE)


def kmeans_clusters(vectors: DataFrame, k: int = CLUSTERS, starts: int = STARTS, seed: int = FIRST_SEED) -> DataFrame:
    """Cluster labels from the best fit."""
    rows = kmeans.stored_rows(vectors)
    return kmeans.assign(rows, kmeans.fit(rows, k, starts, seed, TOLERANCE))


def check_clusters(vectors: DataFrame, k: int = CLUSTERS, starts: int = STARTS, seed: int = FIRST_SEED) -> DataFrame:
    """Properties of a fit, found again with column expressions: one row.

    ``not_nearest``: rows with a centre nearer than their own; ``off_mean``: clusters whose centre and mean are further
    apart than the tolerance; ``cheaper_starts``: starts that ended below the cost of the labelled rows.
    """
    rows = kmeans.stored_rows(vectors)
    fitted = kmeans.fit(rows, k, starts, seed, TOLERANCE)
    if fitted is None:
        raise ValueError("no rows to fit")
    place = F.transform("place", lambda x: x / F.lit(float(kmeans.GRID)))

    def distance(centre: list[float], point: Column) -> Column:
        gaps = F.zip_with(point, F.array(*map(F.lit, centre)), lambda x, c: (x - c) * (x - c))
        return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap)

    labels = kmeans.assign(rows, fitted).join(rows, "trader")
    measured = labels.withColumn("distances", F.array(*[distance(c, place) for c in fitted.centres]))
    own = F.get("distances", F.col("kmeans_cluster"))
    width = len(fitted.centres[0])
    per_cluster = measured.groupBy("kmeans_cluster").agg(
        F.count("kmeans_cluster").alias("n"),
        F.count_if(own > F.array_min("distances") + 1e-9).alias("not_nearest"),
        F.sum(own).alias("cost"),
        F.array(*[F.avg(F.get(place, F.lit(j))) for j in range(width)]).alias("mean"),
    )
    to_mean = F.get(F.array(*[distance(c, F.col("mean")) for c in fitted.centres]), F.col("kmeans_cluster"))
    # A start's cost is the sum over all rows of distances rounded to the grid.
    slack = F.sum("n") / float(kmeans.GRID) + 1e-6
    cheaper = [(F.lit(cost) + slack < F.sum("cost")).cast("long") for cost in fitted.costs]
    return per_cluster.agg(
        F.sum("n").alias("labelled"),
        F.count("kmeans_cluster").alias("clusters"),
        F.sum("not_nearest").alias("not_nearest"),
        F.count_if(to_mean > TOLERANCE**2).alias("off_mean"),
        sum(cheaper[1:], cheaper[0]).alias("cheaper_starts"),
    )


def check_report(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Per feature what the report's clusters add up to: traders, weighted mean, and whether medians fit.

    ``medians_split``: in every cluster at least half of the traders are at or below the median, and at or above it.
    """
    report = cut_lineage(cluster_report(labelled, cluster))
    long = _unpivot(labelled, [cluster], NUMERIC_FEATURES).filter(F.col("value").isNotNull())
    placed = long.join(report, [cluster, "feature"])
    sides = placed.groupBy(cluster, "feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("mean").alias("mean"),
        F.max("global_mean").alias("global_mean"),
        F.count_if(F.col("value") <= F.col("median")).alias("below"),
        F.count_if(F.col("value") >= F.col("median")).alias("above"),
    )
    split = (F.col("below") * 2 >= F.col("n")) & (F.col("above") * 2 >= F.col("n"))
    return sides.groupBy("feature").agg(
        F.sum("n").alias("traders"),
        half_even(F.sum(F.col("mean") * F.col("n")) / F.sum("n"), 6).alias("weighted_mean"),
        half_even(F.max("global_mean"), 6).alias("global_mean"),
        F.bool_and(split).alias("medians_split"),
    )


def _unpivot(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.col(name).cast("double").alias("value"))
            for name in features
        ]
    )
    return df.select(*keys, F.inline(pairs))


def cluster_report(
    labelled: DataFrame, cluster: str = "cluster", features: Sequence[str] = NUMERIC_FEATURES
) -> DataFrame:
    """Mean, median, global mean and difference per cluster and feature.

    The global mean is folded from the per-cluster sums, so no second pass over
    the traders is needed.
    """
    long = _unpivot(labelled, [cluster], features)
    sums = long.groupBy(cluster, "feature").agg(
        F.sum("value").alias("sum"), F.count("value").alias("count")
    )
    # One row per cluster in each feature's window.
    whole = W.partitionBy("feature")
    mean, overall = F.col("sum") / F.col("count"), F.sum("sum").over(whole) / F.sum("count").over(whole)
    means = sums.filter(F.col("count") > 0).select(
        cluster, "feature", mean.alias("mean"), overall.alias("global_mean")
    )
    diff = F.col("mean") - F.col("global_mean")
    return (
        means.join(exact_medians(long, [cluster, "feature"], "value"), [cluster, "feature"])
        .withColumn("diff", diff)
        .withColumn(
            "diff_pct",
            F.when(F.col("global_mean") != 0, diff / F.col("global_mean") * 100).otherwise(F.lit(0.0)),
        )
    )


# Legend medians, then the archetype names.
LEGEND_MEASURES = {
    "win": "win_rate",
    "trades": "total_trade_number",
    "size": "avg_trade_size",
    "ppt": "profit_per_trade",
    "odds": "avg_odds",
}
ARCHETYPES = (
    "Gamblers",
    "Avg. Traders",
    "Grinders",
    "Good Traders",
    "Rich Avg. Traders 1",
    "Rich Avg. Traders 2",
    "Exceptionally Bad Traders",
)


def _archetype() -> Column:
    """A name from the ranks within the clusters, since label numbers are arbitrary."""
    win, trades, size = F.col("rank_win"), F.col("rank_trades"), F.col("rank_size")
    ppt, odds = F.col("rank_ppt"), F.col("rank_odds")
    gambler, average, grinder, good, rich_often, rich, bad = [F.lit(name) for name in ARCHETYPES]
    return (
        F.when((ppt <= 0) & (size >= 0.5), bad)
        .when((odds <= 0.2) & (win <= 0.2), gambler)
        .when(trades >= 0.9, grinder)
        .when(win >= 0.9, good)
        .when((size >= 0.6) & (trades >= 0.5), rich_often)
        .when(size >= 0.6, rich)
        .otherwise(average)
    )


def cluster_legend(labelled: DataFrame, cluster: str = "cluster", include_sales: bool = True) -> DataFrame:
    """Size, medians and rank among the clusters, with an archetype name.

    The rank windows hold one row per cluster, a number the caller chose.
    """
    suffix = "" if include_sales else BUYS_ONLY
    known = labelled.filter(F.col(cluster).isNotNull())
    # Trade count and size pass through a logarithm on their way to the legend,
    # which has no value below zero.
    measures = {
        short: F.when(F.col(name + suffix) >= 0, F.col(name + suffix).cast("double"))
        if short in ("trades", "size")
        else F.col(name + suffix).cast("double")
        for short, name in LEGEND_MEASURES.items()
    }
    narrow = known.select(cluster, *[value.alias(short) for short, value in measures.items()])
    sizes = narrow.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    medians = (
        exact_medians(_unpivot(narrow, [cluster], list(measures)), [cluster, "feature"], "value")
        .groupBy(cluster)
        .pivot("feature", list(measures))
        .agg(F.first("median"))
    )
    joined = sizes.join(medians, cluster, "left")
    everyone = F.count(F.lit(1)).over(W.partitionBy())
    ranks = {}
    for short in measures:
        among = W.partitionBy(F.col(short).isNull()).orderBy(short)
        ranks[f"rank_{short}"] = (
            F.when(F.col(short).isNull(), F.lit(0.5))
            .when(everyone <= 1, F.lit(1.0))
            .otherwise((F.rank().over(among) - 1) / (everyone - 1))
        )
    return joined.withColumns(ranks).withColumn("name", _archetype())
