"""Per-trader metrics, the win-rate leaderboard and the proxy rate per category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillscope.functions import fills
from fillscope.functions.numeric import RATIO_GRID, clamp, grid_sum, half_even, long_sum, on_grid
from fillscope.functions.times import SECONDS_PER_DAY
from fillscope.operators.markets import DEFAULT_THRESHOLD, tokens
from fillscope.operators.positions import position_units
from fillscope.scale import lookup_join
from fillscope.schemas import BUYS_ONLY, require_columns

# Fixed values of the proxy win rate.
PROXY_BASE = 0.40
PROXY_SCORE_WEIGHT = 0.30
PROXY_ACTIVITY_WEIGHT = 0.05
PROXY_ACTIVITY_CAP = 500
PROXY_RANGE = (0.25, 0.75)


def win_rate_leaderboard(
    trades: DataFrame,
    markets: DataFrame,
    more_than: int = 50,
    top: int = 100,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Best win rates of buyers over resolved tokens.

    The buyer is the maker when the maker pays dollars and the taker otherwise, so
    one scan of the trades covers both branches. Fills are first counted per buyer
    and token: the lookup then sees each pair once, and a hot token or a hot buyer
    shrinks before any row of it meets the dimension.
    """
    outcomes = (
        tokens(markets, threshold)
        .filter("resolved")
        .select("token", F.col("implied_outcome").alias("won"))
    )
    buyer = F.when(fills.maker_pays_dollars(), F.col("maker")).otherwise(F.col("taker"))
    bought = trades.select(buyer.alias("user_address"), fills.traded_token().alias("token")).filter(
        F.col("token").isNotNull()
    )
    pairs = bought.groupBy("user_address", "token").agg(F.count(F.lit(1)).alias("fills"))
    wins = F.sum(F.when(F.col("won"), F.col("fills")).otherwise(F.lit(0)))
    totals = (
        lookup_join(pairs, outcomes, "token")
        .groupBy("user_address")
        .agg(F.sum("fills").alias("trade_count"), wins.alias("wins"))
    )
    return (
        totals.filter(F.col("trade_count") > more_than)
        .withColumn("win_rate", F.col("wins") / F.col("trade_count"))
        .orderBy(F.desc("win_rate"), F.desc("trade_count"), F.asc_nulls_last("user_address"))
        .limit(top)
    )


def _sums(prefix: str, where: Column | None) -> list[Column]:
    """The aggregates behind the metrics, over all positions or those that ``where`` keeps.

    Amounts, and ratios on a fixed grid, are summed as integers, so the sums do not depend on
    partitioning, retries or the order of shuffle blocks.
    """
    kept = F.lit(True) if where is None else where
    sums = {
        "n": F.count_if(kept),
        "wins": F.count_if(kept & F.col("won")),
        "dollars": long_sum(F.col("dollar_units"), where),
        "gains": long_sum(F.col("profit_units"), where),
        "odds": grid_sum(F.col("odds"), where),
        "first": F.min(F.when(kept, F.col("epoch"))),
        "last": F.max(F.when(kept, F.col("epoch"))),
    }
    return [value.alias(prefix + name) for name, value in sums.items()]


def _measures(sums: str, suffix: str) -> list[Column]:
    """The eight metrics from the columns of one set of sums."""
    expressions = {
        "win_rate": "{0}wins / {0}n",
        "avg_trade_size": "(double({0}dollars) / 1e6D) / {0}n",
        "total_trade_volume": "double({0}dollars) / 1e6D",
        "total_trade_number": "{0}n",
        "frequency": f"if({{0}}n > 1, {{0}}n / (floor(({{0}}last - {{0}}first) / {SECONDS_PER_DAY}) + 1), 0D)",
        "net_gains_loss": "double({0}gains) / 1e6D",
        "avg_odds": f"double({{0}}odds) / {RATIO_GRID}D / {{0}}n",
        "profit_per_trade": "(double({0}gains) / 1e6D) / {0}n",
    }
    return [F.expr(text.format(sums)).alias(name + suffix) for name, text in expressions.items()]


def trader_stats(
    trades: DataFrame,
    blocks: DataFrame,
    markets: DataFrame,
    traders: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Sixteen metrics per trader, over all positions and over buys only.

    One aggregate with partial sums on the map side: a trader with a third of all
    fills reaches the reducer as one row per map task.
    """
    units = position_units(trades, blocks, markets, traders, threshold)
    sums = units.groupBy("trader").agg(*_sums("all_", None), *_sums("buy_", F.col("bought_contract")))
    return sums.filter("buy_n > 0").select(
        "trader", *_measures("all_", ""), *_measures("buy_", BUYS_ONLY)
    )


def _priced_sides(fills_: DataFrame, *keys: Column) -> DataFrame:
    """A maker row at the implied price and a taker row at its complement, with the fill's keys."""
    price = F.col("maker_price")

    def side(trader: str, value: Column, amount: str) -> Column:
        return F.struct(F.col(trader).alias("trader"), value.alias("implied_price"), F.col(amount).alias("units"))

    priced = fills_.withColumn("maker_price", fills.implied_price(F.col("maker_amount"), F.col("taker_amount")))
    sides = F.array(
        side("maker", price, "maker_amount"), side("taker", F.lit(100.0) - price, "taker_amount")
    )
    known = F.col("transaction_hash").isNotNull() & F.col("log_index").isNotNull()
    found = priced.filter(known).select("category", *keys, F.inline(sides))
    return found.dropna(subset=["trader", "category", "implied_price"])


def two_sided_positions(fills_: DataFrame) -> DataFrame:
    """One row per side of a fill: trader, category, implied price, size and fill id."""
    sides = _priced_sides(fills_, fills.fill_id().alias("fill_id"))
    return sides.select("category", "fill_id", "trader", "implied_price", F.col("units").cast("double").alias("position_size"))


def proxy_win_rates(categorized_trades: DataFrame) -> DataFrame:
    """Heuristic win rate and sizes per trader and category.

    All measures are first summed per trader, category and fill, so that a hot trader is spread over
    many tasks and the fills are counted without a second pass.
    """
    require_columns(
        categorized_trades,
        ("maker", "taker", "maker_amount", "taker_amount", "category", "transaction_hash", "log_index"),
        "categorized trades",
    )
    sides = _priced_sides(categorized_trades, F.col("transaction_hash"), F.col("log_index"))
    score = clamp(F.lit(1.0) - F.abs(F.col("implied_price") - 50.0) / 50.0, 0.0, 1.0)
    # A fill has few rows per trader, so plain sums of longs do here.
    per_fill = sides.groupBy("trader", "category", "transaction_hash", "log_index").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(on_grid(score)).alias("score"),
        F.sum(on_grid(F.col("implied_price"))).alias("price"),
        F.sum("units").alias("units"),
    )
    total = {name: long_sum(F.col(name)).cast("double") for name in ("score", "price", "units")}
    n = F.sum("n")
    grouped = per_fill.groupBy("trader", "category").agg(
        n.alias("n_positions"),
        F.count(F.lit(1)).alias("n_fills"),
        (total["score"] / RATIO_GRID / n).alias("avg_score"),
        (total["price"] / RATIO_GRID / n).alias("avg_implied_price"),
        (total["units"] / n).alias("avg_position_size"),
        total["units"].alias("total_position_size"),
    )
    activity = clamp(
        F.log1p(F.col("n_positions").cast("double")) / F.log(F.lit(1.0 + PROXY_ACTIVITY_CAP)), 0.0, 1.0
    )
    rate = clamp(
        F.lit(PROXY_BASE)
        + F.col("avg_score") * PROXY_SCORE_WEIGHT
        + activity * PROXY_ACTIVITY_WEIGHT,
        *PROXY_RANGE,
    )
    return grouped.select(
        "trader",
        "category",
        half_even(rate, 4).alias("win_rate_proxy"),
        "n_positions",
        half_even(F.col("avg_implied_price"), 2).alias("avg_implied_price"),
        half_even(F.col("avg_position_size"), 2).alias("avg_position_size"),
        half_even(F.col("total_position_size"), 2).alias("total_position_size"),
        "n_fills",
        F.col("n_fills").alias("total_trade_number"),
    )
