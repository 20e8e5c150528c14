"""The registered queries, by name, over one dataset folder.

Every query derives markets, trades and blocks from the folder's tables and runs
over all of them. Two parameters differ from the library defaults, because the
sample data is small: the sample keeps one trader in five with at least twenty
trades.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fillscope import schemas
from fillscope.functions.numeric import half_even, hash_bucket, is_finite
from fillscope.operators import categories, clusters, features, markets, neighbours, points, positions, stats, subset
from fillscope.scale import cut_lineage, shared_folder
from fillscope.sources import catalog, layouts, readers, sinks
from fillscope.sources.sample_tables import SampleTables, derive_trades
from fillscope.streaming import incremental
from fillscope.streaming.trader_counts import stream_trader_counts

Query = Callable[[SparkSession, str], DataFrame]

RATE, MIN_TRADES, USER, FIXED_CLUSTERS = 5, 20, "0xC00000042", 7
NTH_FILL, MONTH = 2999, "1996-03"
PLOT = {"max_points": 1000, "x_field": "avg_odds", "y_field": "win_rate"}
PLOT_MODE = {**PLOT, "category": "Crypto", "min_trades": MIN_TRADES, "include_sales": True}

QUERIES: dict[str, Query] = {}


def query(build: Callable[[SampleTables], DataFrame]) -> Query:
    """Register a query under its function name (without a trailing underscore)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(SampleTables(spark, sf_dir))

    run.__name__, run.__doc__ = build.__name__.rstrip("_"), build.__doc__
    QUERIES[run.__name__] = run
    return run


def _rounded(df: DataFrame, names, digits: int = 6) -> DataFrame:
    """Round doubles whose last bits depend on the order of a sum or on libm."""
    return df.withColumns({name: half_even(F.col(name), digits) for name in names})


# --- markets and tokens ------------------------------------------------------------


@query
def markets_expanded(t: SampleTables) -> DataFrame:
    return markets.expand_markets(t.markets).select(
        "condition_id",
        "question",
        "yes_token",
        "no_token",
        F.col("yes_price").cast("double").alias("yes_price"),
        F.col("no_price").cast("double").alias("no_price"),
    )


@query
def tokens(t: SampleTables) -> DataFrame:
    return markets.tokens(t.markets)


@query
def token_outcome_counts(t: SampleTables) -> DataFrame:
    return markets.token_outcome_counts(markets.tokens(t.markets))


@query
def market_tokens(t: SampleTables) -> DataFrame:
    return markets.market_tokens(t.markets).drop("condition_id")


@query
def market_categories(t: SampleTables) -> DataFrame:
    both = markets.categorize(F.col("question"), markets.MARKET_RULES)
    older = markets.categorize(F.col("question"), markets.HISTOGRAM_RULES)
    return t.markets.select("condition_id", "question", both.alias("category"), older.alias("older_category"))


@query
def market_distribution(t: SampleTables) -> DataFrame:
    return categories.market_distribution(t.markets)


@query
def misc_questions(t: SampleTables) -> DataFrame:
    return categories.misc_questions(t.markets)


# --- trader counts and subsets -----------------------------------------------------


@query
def win_rate_leaderboard(t: SampleTables) -> DataFrame:
    return stats.win_rate_leaderboard(t.trades, t.markets)


@query
def trades_by_maker(t: SampleTables) -> DataFrame:
    return subset.trades_by_maker(t.trades, more_than=MIN_TRADES)


@query
def trader_counts(t: SampleTables) -> DataFrame:
    return subset.trader_counts(t.trades)


@query
def active_trader_count(t: SampleTables) -> DataFrame:
    active = subset.active_traders(subset.trader_counts(t.trades))
    return active.agg(F.count(F.lit(1)).alias("n"))


@query
def traders_sampled(t: SampleTables) -> DataFrame:
    return subset.sample_traders(t.trades, RATE, MIN_TRADES)


@query
def trades_sampled(t: SampleTables) -> DataFrame:
    return subset.sample_trades(t.trades, RATE, MIN_TRADES)


@query
def exact_address(t: SampleTables) -> DataFrame:
    """The lookup for every taker address, spelled in capitals."""
    targets = t.trades.select(F.upper("taker").alias("target")).filter("target is not null").distinct()
    return subset.exact_addresses(t.trades, targets)


@query
def user_trade_count(t: SampleTables) -> DataFrame:
    return subset.count_trades_of(t.trades, USER)


@query
def trader_counts_stream(t: SampleTables) -> DataFrame:
    """The trader counts, kept by a streaming query over the order-line files."""
    return stream_trader_counts(derive_trades(_line_stream(t), t.table("orders")))


def _line_stream(t: SampleTables) -> DataFrame:
    return (
        t.spark.readStream.schema(t.table("lineitem").schema)
        .option("maxFilesPerTrigger", 100)
        .option("pathGlobFilter", "lineitem*.parquet")
        .parquet(t.folder)
    )


def _loaded(t: SampleTables) -> str:
    """Trades loaded from the order-line files, and loaded again by a query that starts over."""
    target = shared_folder(t.spark, "loaded-trades")
    for _ in range(2):
        checkpoint = shared_folder(t.spark, "load-checkpoint")
        incremental.load_files(_line_stream(t), target, checkpoint, lambda lines: derive_trades(lines, t.table("orders")))
    return target


@query
def trades_loaded(t: SampleTables) -> DataFrame:
    return incremental.loaded_trades(t.spark, _loaded(t), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.trades.schema))


@query
def trader_counts_loaded(t: SampleTables) -> DataFrame:
    return incremental.loaded_counts(t.spark, _loaded(t))


@query
def address_index(t: SampleTables) -> DataFrame:
    """The fills of one address, looked up in the index in another spelling, with its exact form."""
    path = shared_folder(t.spark, "address-index")
    layouts.store_address_index(t.trades, path)
    exact = layouts.indexed_address(t.spark, path, USER.lower())
    own = layouts.indexed_trades(t.spark, path, USER.upper()).select(*schemas.TRADES.fieldNames(), "address_key", "role")
    return own.join(exact.select(F.lower("maker").alias("address_key"), F.col("maker").alias("exact_address")), "address_key", "left").drop("address_key")


@query
def nth_fill(t: SampleTables) -> DataFrame:
    """The fill at a position of the chain's order."""
    return catalog.nth_row(t.trades, NTH_FILL, ["block_number", "transaction_hash", "log_index"])


# --- positions and profit ----------------------------------------------------------


@query
def trades_with_time(t: SampleTables) -> DataFrame:
    return positions.trades_with_time(t.trades, t.blocks)


@query
def positions_(t: SampleTables) -> DataFrame:
    return positions.positions(t.trades, t.blocks, t.markets)


@query
def bucketed_positions(t: SampleTables) -> DataFrame:
    """Positions from fills and tokens that are stored in the same buckets."""
    fills_name, tokens_name = layouts.store_bucketed(t.trades, t.blocks, t.markets)
    return layouts.bucketed_positions(t.spark, fills_name, tokens_name)


@query
def trades_of_days(t: SampleTables) -> DataFrame:
    """Trades with block time of the blocks of one month, from trades stored by day."""
    path = shared_folder(t.spark, "trades-by-day")
    blocks = cut_lineage(t.blocks)
    layouts.store_by_day(t.trades, blocks, path)
    return layouts.trades_of_blocks(t.spark, path, blocks.where(F.col("timestamp").startswith(MONTH)))


@query
def rejected_sides(t: SampleTables) -> DataFrame:
    """Sides of fills that are no positions, with the reason."""
    return positions.split_rejects(positions.judged_sides(t.trades, t.blocks, t.markets)).rejects


@query
def reject_counts(t: SampleTables) -> DataFrame:
    """Sides by reason as observed while the rejects are written; 'kept' are the positions."""
    found = positions.split_rejects(positions.judged_sides(t.trades, t.blocks, t.markets))
    rows = [(reason or "kept", n) for reason, n in found.counts.items()]
    return t.spark.createDataFrame(rows, "reason string, n bigint").where("n > 0")


@query
def sampled_positions(t: SampleTables) -> DataFrame:
    """Positions of the sampled traders only."""
    sampled = cut_lineage(subset.sample_traders(t.trades, RATE, MIN_TRADES))
    found = positions.positions(t.trades, t.blocks, t.markets, traders=sampled)
    return found.select("trader", "token", "block_number", "bought_contract", "won", "profit")


@query
def user_trades(t: SampleTables) -> DataFrame:
    return positions.user_trades(t.trades, t.markets, USER)


@query
def user_pnl(t: SampleTables) -> DataFrame:
    return positions.user_pnl(t.trades, t.markets)


@query
def user_total_profit(t: SampleTables) -> DataFrame:
    return positions.total_profit(positions.profit_rows(t.trades, t.markets))


# --- trader metrics ----------------------------------------------------------------


def _stats(t: SampleTables) -> DataFrame:
    return stats.trader_stats(t.trades, t.blocks, t.markets)


def _updated(t: SampleTables) -> DataFrame:
    primary = categories.trader_primary_category(categories.trade_categories(t.trades, t.markets))
    return categories.updated_trader_stats(_stats(t), primary)


def _categorized(t: SampleTables) -> DataFrame:
    """Categories with the history of an earlier run, whose addresses are in capitals.

    The history, one row per maker, is stored; the fills are read again rather than stored in between.
    """
    primary = categories.trader_primary_category(categories.trade_categories(t.trades, t.markets))
    past = cut_lineage(primary.select(F.upper("trader").alias("trader"), "primary_category"))
    return categories.trade_categories(t.trades, t.markets, past)


@query
def trader_stats(t: SampleTables) -> DataFrame:
    return _stats(t)


@query
def sampled_trader_stats(t: SampleTables) -> DataFrame:
    """Metrics of the sampled traders, from their own fills."""
    sampled = cut_lineage(subset.sample_traders(t.trades, RATE, MIN_TRADES))
    return stats.trader_stats(t.trades, t.blocks, t.markets, traders=sampled)


@query
def address_chain(t: SampleTables) -> DataFrame:
    """One spelling of an address, its exact form, and the number of its trades."""
    exact = subset.exact_address(t.trades, USER.lower()).first()
    address = exact.maker if exact else None
    return subset.count_trades_of(t.trades, address).select(F.lit(address).cast("string").alias("address"), "n")


@query
def two_sided_positions(t: SampleTables) -> DataFrame:
    return stats.two_sided_positions(categories.trade_categories(t.trades, t.markets))


@query
def winrate_proxy(t: SampleTables) -> DataFrame:
    return stats.proxy_win_rates(_categorized(t))


# --- categories --------------------------------------------------------------------


@query
def trade_categories(t: SampleTables) -> DataFrame:
    return _categorized(t)


@query
def trader_primary_category(t: SampleTables) -> DataFrame:
    return categories.trader_primary_category(categories.trade_categories(t.trades, t.markets))


@query
def updated_trader_stats(t: SampleTables) -> DataFrame:
    return _updated(t)


@query
def category_distribution(t: SampleTables) -> DataFrame:
    return categories.category_distribution(categories.trade_categories(t.trades, t.markets))


@query
def trade_activity_by_category(t: SampleTables) -> DataFrame:
    return categories.trade_activity_by_category(t.trades, t.markets)


@query
def category_onehot(t: SampleTables) -> DataFrame:
    primary = categories.trader_primary_category(categories.trade_categories(t.trades, t.markets))
    return categories.with_one_hot(primary)


@query
def category_decode(t: SampleTables) -> DataFrame:
    primary = categories.trader_primary_category(categories.trade_categories(t.trades, t.markets))
    decoded = categories.with_decoded_category(categories.with_one_hot(primary))
    return decoded.select("trader", "decoded_category")


@query
def category_comparison(t: SampleTables) -> DataFrame:
    """Trader histogram of the metrics table against that of all makers."""
    primary = cut_lineage(
        categories.trader_primary_category(categories.trade_categories(t.trades, t.markets))
    )
    updated = categories.updated_trader_stats(_stats(t), primary)
    return categories.category_comparison(updated, categories.with_one_hot(primary))


@query
def category_total_difference(t: SampleTables) -> DataFrame:
    primary = cut_lineage(
        categories.trader_primary_category(categories.trade_categories(t.trades, t.markets))
    )
    updated = categories.updated_trader_stats(_stats(t), primary)
    return categories.total_difference(categories.category_comparison(updated, categories.with_one_hot(primary)))


# --- features, clusters and reports ------------------------------------------------


def _fixed_label(trader: Column) -> Column:
    return hash_bucket(trader, FIXED_CLUSTERS).cast("int")


def _clustered(t: SampleTables) -> DataFrame:
    """Updated metrics with a label by address hash, which SQL can reproduce."""
    return cut_lineage(_updated(t)).withColumn("cluster", _fixed_label(F.col("trader")))


@query
def trader_features(t: SampleTables) -> DataFrame:
    scaled = features.scaled_features(cut_lineage(_updated(t)))
    return _rounded(scaled, features.NUMERIC_FEATURES)


@query
def kmeans_clusters(t: SampleTables) -> DataFrame:
    vectors = features.feature_vectors(features.scaled_features(cut_lineage(_updated(t))))
    return clusters.kmeans_clusters(cut_lineage(vectors))


@query
def feature_projection(t: SampleTables) -> DataFrame:
    vectors = features.feature_vectors(features.scaled_features(cut_lineage(_updated(t))))
    return features.project(cut_lineage(vectors))


@query
def kmeans_check(t: SampleTables) -> DataFrame:
    """What holds for a fit whatever its labels: nearest centres, centres at their means, least cost."""
    vectors = features.feature_vectors(features.scaled_features(cut_lineage(_updated(t))))
    return clusters.check_clusters(cut_lineage(vectors))


@query
def projection_check(t: SampleTables) -> DataFrame:
    """What SQL knows of a projection: a place for all, widest axis first, axes without correlation."""
    vectors = features.feature_vectors(features.scaled_features(cut_lineage(_updated(t))))
    placed = features.project(cut_lineage(vectors))
    return placed.agg(
        F.count("proj_1").alias("n"),
        (F.var_pop("proj_1") >= F.var_pop("proj_2")).alias("first_is_wider"),
        F.abs(half_even(F.corr("proj_1", "proj_2"), 6)).alias("correlation"),
    )


@query
def layout_check(t: SampleTables) -> DataFrame:
    """What SQL knows of the neighbour layout: a place for all, and truer neighbourhoods than the projection has."""
    vectors = cut_lineage(features.feature_vectors(features.scaled_features(cut_lineage(_updated(t)))))
    placed = cut_lineage(neighbours.neighbour_layout(vectors))
    trusted = neighbours.trustworthiness(vectors, placed, ("place_1", "place_2"))
    projected = neighbours.trustworthiness(vectors, cut_lineage(features.project(vectors)), ("proj_1", "proj_2"))
    finite = is_finite(F.col("place_1")) & is_finite(F.col("place_2"))
    return placed.agg(
        F.count_if(finite).alias("n"),
        F.countDistinct("trader").alias("traders"),
        F.lit(trusted > projected).alias("truer_than_projection"),
    )


def _fitted(t: SampleTables) -> tuple[DataFrame, DataFrame]:
    """Updated metrics, and the fitted label and place of every trader, both stored."""
    updated = cut_lineage(_updated(t))
    vectors = cut_lineage(features.feature_vectors(features.scaled_features(updated)))
    placed = clusters.kmeans_clusters(vectors).join(features.project(vectors), "trader", "full")
    return updated, cut_lineage(placed)


def _clustered_traders(t: SampleTables) -> DataFrame:
    """Metrics, category flags, fitted label and place of every trader."""
    updated, placed = _fitted(t)
    joined = categories.with_one_hot(updated).join(placed, "trader", "left")
    return joined.select(schemas.CLUSTERED_TRADERS.fieldNames())


def _as_presence(df: DataFrame) -> DataFrame:
    """Label and place, which a fit decides, as whether they are there."""
    label = F.col("kmeans_cluster").between(0, clusters.CLUSTERS - 1)
    place = F.col("proj_1").isNotNull() & F.col("proj_2").isNotNull()
    return df.select("*", F.coalesce(label, F.lit(False)).alias("labelled"), place.alias("placed")).drop("kmeans_cluster", "proj_1", "proj_2")


@query
def clustered_traders(t: SampleTables) -> DataFrame:
    return _as_presence(_clustered_traders(t))


@query
def refresh_fitted_clusters(t: SampleTables) -> DataFrame:
    """Fresh metrics with the fitted labels of an earlier run, whose addresses are in capitals."""
    updated, placed = _fitted(t)
    earlier = categories.with_one_hot(updated).join(placed, "trader", "left").withColumn("trader", F.upper("trader"))
    return _as_presence(categories.refresh_clusters(updated, earlier))


@query
def fitted_report_check(t: SampleTables) -> DataFrame:
    """What the report over fitted labels adds up to, per feature."""
    updated, placed = _fitted(t)
    return clusters.check_report(cut_lineage(updated.join(placed, "trader")), "kmeans_cluster")


@query
def fitted_legend_check(t: SampleTables) -> DataFrame:
    """What the legend over fitted labels adds up to: traders, clusters, names, and the ends of its ranks."""
    updated, placed = _fitted(t)
    legend = clusters.cluster_legend(cut_lineage(updated.join(placed, "trader")), "kmeans_cluster")
    ranks = [f"rank_{short}" for short in clusters.LEGEND_MEASURES]
    return legend.agg(
        F.sum("n").alias("traders"),
        F.count("kmeans_cluster").alias("clusters"),
        F.count_if(F.col("name").isin(*clusters.ARCHETYPES)).alias("named"),
        F.least(*map(F.min, ranks)).alias("lowest_rank"),
        F.greatest(*map(F.max, ranks)).alias("highest_rank"),
    )


@query
def fitted_viz_rows(t: SampleTables) -> DataFrame:
    """Plot rows of clustered traders; the category comes back from the flags."""
    return _as_presence(points.plot_rows(_clustered_traders(t))).select("trader", "category", *schemas.FLAG_COLUMNS, "labelled", "placed")


@query
def cluster_report(t: SampleTables) -> DataFrame:
    report = clusters.cluster_report(_clustered(t))
    return _rounded(report, ("mean", "median", "global_mean", "diff", "diff_pct"))


@query
def cluster_legend(t: SampleTables) -> DataFrame:
    legend = clusters.cluster_legend(_clustered(t))
    return _rounded(legend, clusters.LEGEND_MEASURES)


@query
def kmeans_cluster_report(t: SampleTables) -> DataFrame:
    """The report over fitted k-means labels."""
    updated = cut_lineage(_updated(t))
    vectors = cut_lineage(features.feature_vectors(features.scaled_features(updated)))
    labels = clusters.kmeans_clusters(vectors)
    return clusters.cluster_report(cut_lineage(updated.join(labels, "trader")), "kmeans_cluster")


@query
def refresh_clusters(t: SampleTables) -> DataFrame:
    updated = cut_lineage(_updated(t))
    earlier = updated.select(
        F.upper("trader").alias("trader"), _fixed_label(F.col("trader")).alias("kmeans_cluster")
    )
    return categories.refresh_clusters(updated, earlier)


# --- plot data ---------------------------------------------------------------------


def _plot_rows(t: SampleTables) -> DataFrame:
    return points.plot_rows(categories.with_one_hot(_updated(t)))


@query
def viz_rows(t: SampleTables) -> DataFrame:
    rows = _plot_rows(t).drop(*schemas.FLAG_COLUMNS)
    logs = [name + suffix for name in points.LOG_FIELDS for suffix in ("", schemas.BUYS_ONLY)]
    return _rounded(rows, logs, 9)


@query
def viz_points(t: SampleTables) -> DataFrame:
    kept = points.thin_points(cut_lineage(_plot_rows(t)), **PLOT)
    return _rounded(kept.select("trader", "category", "part", "radius"), ["radius"])


@query
def viz_points_of_category(t: SampleTables) -> DataFrame:
    """The plot's other modes: one category, more trades, sales included."""
    kept = points.thin_points(cut_lineage(_plot_rows(t)), **PLOT_MODE)
    return _rounded(kept.select("trader", "category", "part", "radius"), ["radius"])


@query
def axis_profile_with_sales(t: SampleTables) -> DataFrame:
    return _rounded(points.axis_profile(_plot_rows(t), include_sales=True), ("min_value", "max_value", "ratio"))


@query
def axis_profile(t: SampleTables) -> DataFrame:
    return _rounded(points.axis_profile(_plot_rows(t)), ("min_value", "max_value", "ratio"))


# --- sources, sinks and catalogue --------------------------------------------------


@query
def csv_roundtrip(t: SampleTables) -> DataFrame:
    path = shared_folder(t.spark, "trades-csv")
    sinks.write_csv(t.trades, path)
    return readers.read_csv(t.spark, path, schemas.TRADES)


@query
def parquet_roundtrip(t: SampleTables) -> DataFrame:
    return catalog.store(t.trades, purpose="trades-parquet")


@query
def catalog_objects(t: SampleTables) -> DataFrame:
    """The stored markets and the view over the stored trades, read back from the catalogue."""
    files = shared_folder(t.spark, "trade-files")
    sinks.write_parquet(t.trades, files)
    found = catalog.describe_objects(t.spark, catalog.register_warehouse(t.spark, t.markets, files))
    # Where the files lie differs from run to run.
    view = F.regexp_replace("definition", "`[^`]*/trade-files-[^`]*`", "files")
    table = F.regexp_replace(view, "(?s)LOCATION '[^']*'.*", "LOCATION files")
    return found.withColumn("definition", F.trim(F.regexp_replace(table, "\\s+", " ")))


@query
def dataset_profile(t: SampleTables) -> DataFrame:
    found = catalog.profile_dataset(t.spark, t.folder)
    return found.select("below_root", "file_name", "total_rows", "n_columns", "schema")


@query
def dataset_ranges(t: SampleTables) -> DataFrame:
    """Whole-number columns of all files: rows, nulls and range, from footers only."""
    found = catalog.profile_columns(t.spark, t.folder)
    whole = F.col("column_name").rlike("(key|_id|turn|size|n_chars|number|quality|toxic)$")
    return found.where(whole).select(
        "file_name",
        "column_name",
        "total_rows",
        "n_nulls",
        F.col("min_value").cast("long").alias("min_value"),
        F.col("max_value").cast("long").alias("max_value"),
    )


@query
def dataset_preview(t: SampleTables) -> DataFrame:
    """The first five rows of every file, with the value of the file's first column."""
    found = catalog.preview_files(t.spark, t.folder)
    first = F.regexp_extract("row_json", '^[{]"[^"]+": (-?[0-9]+)', 1)
    return found.select("file_name", "position", first.cast("long").alias("first_value"))
