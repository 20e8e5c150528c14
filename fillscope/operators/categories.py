"""Categories of trades and traders, histograms and one-hot columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillscope.functions.categories import HISTOGRAM_RULES, MARKET_RULES, Rules, decode_one_hot, one_hot
from fillscope.functions.fills import DOLLAR_ASSET
from fillscope.functions.numeric import exact_sum, rounded_away
from fillscope.operators.markets import categorized_markets, token_categories
from fillscope.scale import broadcast_planned, cut_lineage, lookup_join, spread_width
from fillscope.schemas import DEFAULT_CATEGORY, FLAG_COLUMNS


def trade_categories(
    trades: DataFrame,
    markets: DataFrame,
    history: DataFrame | None = None,
    rules: Rules = MARKET_RULES,
) -> DataFrame:
    """Add ``cat_by_token``, ``cat_by_history`` and ``category`` to every trade.

    The taker's asset decides, then the maker's, then the maker's earlier primary
    category from ``history`` (used only if it has that column), then the default.

    The dollar is no token, so one lookup on the other asset serves a fill that is paid in dollars. Only a fill of
    two tokens has a key for the second lookup.

    Fills stay where they are while the tokens and the history are small enough to be broadcast. Beyond that, whole
    fills move once instead of once per lookup: the lookups see only the distinct (maker, assets) of the fills of a
    deal, and what they find is stored and meets the fills again within the deal. Fills of one transaction share a
    deal, so that neighbours in a shuffle file have much in common.
    """
    known = token_categories(markets, rules).filter(F.col("token_key") != DOLLAR_ASSET)
    if history is None or "primary_category" not in history.columns:
        found = _token_lookup(trades.withColumns(_asset_keys()), known)
        return _categorized(trades, found.withColumn("cat_by_history", F.lit(None).cast("string")))
    past = history.groupBy(F.lower("trader").alias("history_key")).agg(F.max("primary_category").alias("cat_by_history"))
    if broadcast_planned(known, past):
        found = _token_lookup(trades.withColumns(_asset_keys()), known).withColumn("history_key", F.lower("maker"))
        return _categorized(trades, lookup_join(found, past, "history_key", "left"))
    deals = spread_width(trades.sparkSession)
    named = "transaction_hash" if "transaction_hash" in trades.columns else "maker"
    deal = F.pmod(F.xxhash64(F.coalesce(named, "maker", F.lit(""))), F.lit(deals)).cast("int")
    sought = trades.select(deal.alias("sought_deal"), F.col("maker").alias("sought_maker"), *[key.alias(name) for name, key in _asset_keys().items()])
    distinct = ["sought_deal", "sought_maker", "first_key", "second_key"]
    answers = _token_lookup(sought, known, distinct).withColumn("history_key", F.lower("sought_maker"))
    found = lookup_join(answers, past, "history_key", "left").select(
        "sought_deal",
        "sought_maker",
        F.col("first_key").alias("sought_first"),
        F.col("second_key").alias("sought_second"),
        "cat_by_token",
        "cat_by_history",
    )
    dealt = trades.repartitionById(deals, deal).withColumns(_asset_keys())
    answers = cut_lineage(found).repartitionById(deals, F.col("sought_deal"))
    # The hash comes first, so that sorting compares whole numbers.
    mine = F.xxhash64("maker", "first_key", "second_key")
    met = (
        (mine == F.xxhash64("sought_maker", "sought_first", "sought_second"))
        & (deal == F.col("sought_deal"))
        & F.col("maker").eqNullSafe(F.col("sought_maker"))
        & F.col("first_key").eqNullSafe(F.col("sought_first"))
        & F.col("second_key").eqNullSafe(F.col("sought_second"))
    )
    return _categorized(trades, lookup_join(dealt, answers, met, "left"))


def _asset_keys() -> dict[str, Column]:
    """The asset of a fill's first lookup, and the maker's asset where it is a second token."""
    taker_pays = F.col("taker_asset_id").eqNullSafe(DOLLAR_ASSET)
    both = ~taker_pays & ~F.col("maker_asset_id").eqNullSafe(DOLLAR_ASSET)
    return {
        "first_key": F.lower(F.when(taker_pays, F.col("maker_asset_id")).otherwise(F.col("taker_asset_id"))),
        "second_key": F.lower(F.when(both, F.col("maker_asset_id"))),
    }


def _token_lookup(keyed: DataFrame, known: DataFrame, distinct: list[str] | None = None) -> DataFrame:
    """Add ``cat_by_token``; of rows equal in ``distinct`` one is kept, where they lie after their first lookup.

    Where the lookups move rows, only those of two tokens go through the second one: the others would meet in one task
    under a NULL key. The rows stay on the left of the joins, where adaptive execution splits a partition that
    many of them share.
    """
    first = known.select(F.col("token_key").alias("first_key"), F.col("category").alias("first_category"))
    second = known.select(F.col("token_key").alias("second_key"), F.col("category").alias("second_category"))

    def once(rows: DataFrame) -> DataFrame:
        looked = lookup_join(rows, first, "first_key", "left")
        return looked.groupBy(*distinct).agg(F.first("first_category").alias("first_category")) if distinct else looked

    def twice(rows: DataFrame) -> DataFrame:
        looked = lookup_join(once(rows), second, "second_key", "left")
        return looked.withColumn("cat_by_token", F.coalesce("first_category", "second_category")).drop("first_category", "second_category")

    if broadcast_planned(known):
        return twice(keyed)
    one = once(keyed.where(F.col("second_key").isNull())).withColumnRenamed("first_category", "cat_by_token")
    return one.unionByName(twice(keyed.where(F.col("second_key").isNotNull())))


def _categorized(trades: DataFrame, found: DataFrame) -> DataFrame:
    """The trades' columns and the three categories, from what the lookups found."""
    category = F.coalesce("cat_by_token", "cat_by_history", F.lit(DEFAULT_CATEGORY)).alias("category")
    return found.select(*trades.columns, "cat_by_token", "cat_by_history", category)


def trader_primary_category(categorized_trades: DataFrame) -> DataFrame:
    """Most frequent category per maker, ties by category name.

    Two aggregates with partial results instead of a ranked window: the second one
    sees at most one row per maker and category.
    """
    counts = categorized_trades.groupBy(F.col("maker").alias("trader"), "category").agg(
        F.count(F.lit(1)).alias("cat_count")
    )
    best = F.min(F.struct((-F.col("cat_count")).alias("order"), F.col("category")))
    return counts.groupBy("trader").agg(best["category"].alias("primary_category"))


def updated_trader_stats(stats: DataFrame, primary: DataFrame) -> DataFrame:
    """Put the primary category in front of the metrics, replacing an older one."""
    fresh = primary.select("trader", F.col("primary_category").alias("fresh_category"))
    kept = [c for c in stats.columns if c != "primary_category"]
    return stats.join(fresh, "trader", "left").select(
        F.coalesce("fresh_category", F.lit(DEFAULT_CATEGORY)).alias("primary_category"), *kept
    )


def market_distribution(markets: DataFrame, rules: Rules = HISTOGRAM_RULES) -> DataFrame:
    """Markets and volume in millions per category, summed in millionths of a dollar.

    Rounding to two decimals of a million goes away from zero, here and in the other histogram.
    """
    millionths = exact_sum(F.rint(F.col("market_total_volume") * 1e6))
    return categorized_markets(markets, rules).groupBy("category").agg(
        F.count(F.lit(1)).alias("market_count"),
        (rounded_away(millionths, 10**10) / 100).alias("total_vol_m_usd"),
    )


def misc_questions(markets: DataFrame, rows: int = 10, rules: Rules = HISTOGRAM_RULES) -> DataFrame:
    """The first uncategorised questions in alphabetical order."""
    return (
        categorized_markets(markets, rules)
        .filter(F.col("category") == DEFAULT_CATEGORY)
        .select("question")
        .orderBy(F.asc_nulls_last("question"))
        .limit(rows)
    )


def trade_activity_by_category(
    trades: DataFrame,
    markets: DataFrame,
    rules: Rules = HISTOGRAM_RULES,
) -> DataFrame:
    """Trades and volume per category, a trade counting for every market whose
    condition id is contained in one of its asset ids.

    Containment without comparing all trades with all markets: trades are first
    totalled per asset pair, then each pair offers its substrings of the lengths
    that condition ids have, and these meet the ids in an equi-join.
    """
    by_condition = (
        categorized_markets(markets, rules)
        .filter(F.col("condition_id").isNotNull())
        .groupBy("condition_id", "category")
        .agg(F.count(F.lit(1)).alias("markets"))
    )
    lengths = by_condition.agg(F.collect_set(F.length("condition_id")).alias("lengths"))
    pairs = trades.groupBy(
        F.lower("maker_asset_id").alias("maker_asset"), F.lower("taker_asset_id").alias("taker_asset")
    ).agg(
        F.count(F.lit(1)).alias("fills"),
        exact_sum(F.col("maker_amount").cast("decimal(20,0)") + F.col("taker_amount").cast("decimal(20,0)")).alias("units"),
    )
    wanted = sorted(lengths.first()["lengths"] or [])
    pieces = pairs.select(
        "fills", "units", F.explode(_substrings(("maker_asset", "taker_asset"), wanted)).alias("condition_id")
    )
    return (
        lookup_join(pieces, by_condition, "condition_id")
        .groupBy("category")
        .agg(
            F.sum(F.col("fills") * F.col("markets")).alias("trade_count"),
            (rounded_away(exact_sum(F.col("units") * F.col("markets")), 20_000) / 100).alias("estimated_vol_usd"),
        )
    )


def _pieces(text: Column, length: int) -> Column:
    """The substrings of one length, none for NULL or shorter text."""
    last = F.length(text) - length + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(
        F.transform(starts, lambda start: F.substring(text, start, F.lit(length))),
        F.array().cast("array<string>"),
    )


def _substrings(columns: tuple[str, ...], lengths: list[int]) -> Column:
    """All distinct substrings of the given lengths over several text columns."""
    lists = [_pieces(F.col(name), length) for name in columns for length in lengths]
    return F.array_distinct(F.concat(F.array().cast("array<string>"), *lists))


def category_distribution(categorized_trades: DataFrame) -> DataFrame:
    """Rows and percent of the rows with a category, per category."""
    counts = categorized_trades.filter(F.col("category").isNotNull()).groupBy("category").agg(
        F.count(F.lit(1)).alias("count")
    )
    # The window runs over one row per category.
    whole = F.sum("count").over(W.partitionBy())
    return counts.withColumn("percentage", F.col("count") * 100.0 / whole)


def category_comparison(updated_stats: DataFrame, clustered: DataFrame) -> DataFrame:
    """Category histograms of two stages side by side, with their difference."""

    def histogram(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col("category").isNotNull()).groupBy("category").agg(
            F.count(F.lit(1)).alias(name)
        )

    left = histogram(updated_stats.select(F.col("primary_category").alias("category")), "in_updated_stats")
    flags = [name for name in FLAG_COLUMNS if name in clustered.columns]
    right = histogram(clustered.select(decode_one_hot(flags).alias("category")), "in_clustered_traders")
    merged = left.join(right, "category", "full").fillna(0, ["in_updated_stats", "in_clustered_traders"])
    return merged.withColumn("difference", F.col("in_updated_stats") - F.col("in_clustered_traders"))


def total_difference(comparison: DataFrame) -> DataFrame:
    return comparison.agg(F.coalesce(F.sum(F.abs("difference")), F.lit(0)).alias("total_difference"))


def with_one_hot(stats: DataFrame) -> DataFrame:
    """Replace nothing, add the six flag columns of ``primary_category``."""
    return stats.select("*", *one_hot(F.col("primary_category")))


def with_decoded_category(clustered: DataFrame) -> DataFrame:
    flags = [name for name in FLAG_COLUMNS if name in clustered.columns]
    return clustered.withColumn("decoded_category", decode_one_hot(flags))


def refresh_clusters(updated_stats: DataFrame, clustered: DataFrame) -> DataFrame:
    """Fresh metrics and flags with the cluster columns of an earlier run.

    Addresses match ignoring case. Only the label columns of the earlier run are
    read.
    """
    labels = [c for c in ("kmeans_cluster", "proj_1", "proj_2") if c in clustered.columns]
    earlier = clustered.select(F.lower("trader").alias("trader_key"), *labels)
    return (
        with_one_hot(updated_stats)
        .withColumn("trader_key", F.lower("trader"))
        .join(earlier, "trader_key", "left")
        .drop("trader_key")
    )
