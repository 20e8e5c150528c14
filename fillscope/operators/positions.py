"""Positions: one row per fill and party, with odds, result and profit."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import types as T
from pyspark.sql import functions as F

from fillscope.functions import fills
from fillscope.functions.numeric import long_sum
from fillscope.functions.times import block_epoch, utc_time
from fillscope.operators.markets import DEFAULT_THRESHOLD, expand_markets, token_dimension, tokens
from fillscope.operators.subset import trades_of
from fillscope.scale import cut_lineage, lookup_join, shared_folder, spread_width


def trades_with_time(trades: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every trade with the time text of its block, NULL for an unknown block.

    The block table grows with the chain, so no broadcast is asked for; adaptive
    execution still makes one when the filtered blocks turn out small.
    """
    times = blocks.select("block_number", F.col("timestamp").alias("block_time"))
    return trades.join(times, "block_number", "left")


def _side(trader: str, is_maker: Column, bought: Column) -> Column:
    return F.struct(F.col(trader).alias("trader"), is_maker.alias("is_maker"), bought.alias("bought_contract"))


def _parties() -> Column:
    """Maker and taker with their role; a self-trade yields the maker role twice."""
    maker_buys = F.col("maker_asset_id").eqNullSafe(fills.DOLLAR_ASSET)
    taker_buys = F.col("taker_asset_id").eqNullSafe(fills.DOLLAR_ASSET)
    same = F.col("taker").eqNullSafe(F.col("maker"))
    return F.array(
        _side("maker", F.lit(True), maker_buys),
        _side("taker", same, F.when(same, maker_buys).otherwise(taker_buys)),
    )


def position_units(
    trades: DataFrame,
    blocks: DataFrame,
    markets: DataFrame,
    traders: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Positions with amounts in integer millionths, the base of all metrics.

    Fills of unknown or unresolved tokens and of blocks without a valid time are
    left out. Both lookups run per fill, before the fill becomes two rows, so the
    large side is shuffled once at most per lookup.
    """
    resolved = token_dimension(markets, threshold).filter(F.col("implied_outcome").isNotNull())
    timed = blocks.select("block_number", block_epoch(F.col("timestamp")).alias("epoch")).filter(
        F.col("epoch").isNotNull()
    )
    facts = trades.select(
        "block_number",
        "maker",
        "taker",
        "maker_asset_id",
        "taker_asset_id",
        *[c for c in ("transaction_hash", "log_index") if c in trades.columns],
        fills.traded_token().alias("token"),
        fills.dollar_units().alias("dollar_units"),
        fills.contract_units().alias("contract_units"),
    )
    if traders is not None:
        # Fills of other parties go before they meet the lookups.
        facts = trades_of(facts, traders)
    return units_of(lookup_join(facts, resolved, "token").join(timed, "block_number"), traders)


def units_of(facts: DataFrame, traders: DataFrame | None = None) -> DataFrame:
    """The positions of fills that know their token's outcome and their time."""
    sides = facts.select(
        *[c for c in facts.columns if c not in ("maker", "taker", "maker_asset_id", "taker_asset_id")],
        F.inline(_parties()),
    ).filter(F.col("trader").isNotNull())
    if traders is not None:
        sides = lookup_join(sides, traders.select("trader"), "trader", "left_semi")
    profit = fills.payoff_units(
        F.col("implied_outcome"), F.col("dollar_units"), F.col("contract_units"), F.col("bought_contract")
    )
    return sides.withColumns(
        {
            "odds": F.when(
                F.col("contract_units") != 0,
                (F.col("dollar_units") / fills.UNIT) / (F.col("contract_units") / fills.UNIT),
            ).otherwise(F.lit(0.0)),
            "won": F.col("bought_contract") == F.col("implied_outcome"),
            "profit_units": profit,
        }
    )


# Why a side is no position, in the order in which a fill is tested.
UNKNOWN_TOKEN, UNRESOLVED, NO_BLOCK, BAD_TIME, NO_TRADER = (
    "unknown token",
    "unresolved token",
    "unknown block",
    "invalid block time",
    "unknown trader",
)


def judged_sides(
    trades: DataFrame, blocks: DataFrame, markets: DataFrame, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Every side of every fill with ``reason``: NULL for a position, else why it is none.

    Lookups are left joins, so each fill stays; both sides of a fill share its reason, and a side
    without a trader has its own.
    """
    known = token_dimension(markets, threshold).select("token", "implied_outcome", F.lit(True).alias("listed"))
    timed = blocks.select(
        "block_number", block_epoch(F.col("timestamp")).alias("epoch"), F.lit(True).alias("mined")
    )
    facts = trades.select(
        "transaction_hash", "log_index", "block_number", "maker", "taker", fills.traded_token().alias("token")
    )
    found = lookup_join(lookup_join(facts, known, "token", "left"), timed, "block_number", "left")
    sides = F.array(
        F.struct(F.col("maker").alias("trader"), F.lit("maker").alias("side")),
        F.struct(F.col("taker").alias("trader"), F.lit("taker").alias("side")),
    )
    reason = (
        F.when(F.col("listed").isNull(), UNKNOWN_TOKEN)
        .when(F.col("implied_outcome").isNull(), UNRESOLVED)
        .when(F.col("mined").isNull(), NO_BLOCK)
        .when(F.col("epoch").isNull(), BAD_TIME)
        .when(F.col("trader").isNull(), NO_TRADER)
    )
    return found.select(
        "transaction_hash", "log_index", "block_number", "token", "implied_outcome", "listed", "epoch", "mined", F.inline(sides)
    ).select("transaction_hash", "log_index", "block_number", "token", "side", "trader", reason.alias("reason"))


@dataclass(frozen=True)
class Judged:
    """What a run of ``split_rejects`` wrote: rejected sides, and counts by reason (None: positions)."""

    rejects: DataFrame
    counts: dict[str | None, int]


def split_rejects(sides: DataFrame, path: str | None = None) -> Judged:
    """Write the rejected sides with their reasons, and count all sides on the way.

    The counts are observed while the rows are written: one pass, and one row of numbers at the driver.
    """
    reasons = (UNKNOWN_TOKEN, UNRESOLVED, NO_BLOCK, BAD_TIME, NO_TRADER)
    counted = Observation()
    watched = sides.observe(
        counted,
        F.count_if(F.col("reason").isNull()).alias("kept"),
        *[F.count_if(F.col("reason") == reason).alias(reason) for reason in reasons],
    )
    target = path or shared_folder(sides.sparkSession, "rejects")
    watched.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(target)
    found = counted.get
    rejects = sides.sparkSession.read.schema(sides.schema).parquet(target)
    return Judged(rejects, {None: found["kept"], **{reason: found[reason] for reason in reasons}})


def positions(
    trades: DataFrame,
    blocks: DataFrame,
    markets: DataFrame,
    traders: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Positions in dollars and contracts."""
    return in_dollars(position_units(trades, blocks, markets, traders, threshold))


def in_dollars(units: DataFrame) -> DataFrame:
    """Amounts and profits of positions in dollars and contracts instead of millionths."""
    return units.select(
        *[c for c in ("transaction_hash", "log_index") if c in units.columns],
        "block_number",
        "trader",
        "token",
        "is_maker",
        "bought_contract",
        "question",
        "is_yes_token",
        F.col("implied_outcome").alias("implied_token_outcome"),
        (F.col("is_yes_token") == F.col("implied_outcome")).alias("implied_question_outcome"),
        (F.col("dollar_units") / fills.UNIT).alias("dollar_amount"),
        (F.col("contract_units") / fills.UNIT).alias("contract_amount"),
        "odds",
        "won",
        utc_time(F.col("epoch")).alias("time"),
        (F.col("profit_units") / fills.UNIT).alias("profit"),
    )


def _rich_sides(trades: DataFrame, markets: DataFrame, threshold: float) -> DataFrame:
    """Trades with traded token, its question and outcome, before choosing a user.

    The question comes from every market listing the token and the outcome from
    every token row, so a token listed twice repeats its trades.
    """
    expanded = expand_markets(markets)
    listed = expanded.select(
        F.explode(F.array_distinct(F.array("yes_token", "no_token"))).alias("token"), "question"
    )
    outcomes = tokens(markets, threshold).select("token", "implied_outcome")
    facts = trades.withColumn("token", fills.traded_token())
    return lookup_join(lookup_join(facts, listed, "token"), outcomes, "token")


def _is_buyer(user: Column) -> Column:
    return F.when(fills.maker_pays_dollars(), F.col("maker") == user).otherwise(F.col("taker") == user)


def user_trades(
    trades: DataFrame, markets: DataFrame, user: str, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Trades of one address with token, buyer flag, question and outcome."""
    own = trades.filter((F.col("maker") == user) | (F.col("taker") == user))
    return _rich_sides(own, markets, threshold).withColumn("buyer", _is_buyer(F.lit(user)))


def profit_rows(
    trades: DataFrame, markets: DataFrame, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Price, quantity and profit of every address in each of its trades.

    An unresolved token counts as not paying; a price without quantity is NULL.
    """
    per_user = (
        _rich_sides(trades, markets, threshold)
        .withColumn("user", F.explode(F.array_distinct(F.array("maker", "taker"))))
        .filter(F.col("user").isNotNull())
        .withColumn("buyer", F.coalesce(_is_buyer(F.col("user")), F.lit(False)))
    )
    pays = F.coalesce(F.col("implied_outcome"), F.lit(False))
    dollars, contracts = fills.dollar_units(), fills.contract_units()
    return per_user.select(
        "user",
        "block_number",
        "transaction_hash",
        "log_index",
        "token",
        "question",
        "buyer",
        (contracts / fills.UNIT).alias("quantity"),
        F.try_divide(dollars / fills.UNIT, contracts / fills.UNIT).alias("price"),
        fills.payoff_units(pays, dollars, contracts, F.col("buyer")).alias("profit_units"),
    )


def user_pnl(
    trades: DataFrame, markets: DataFrame, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Profit rows with the running profit of each address, newest block first."""
    return running_profit(profit_rows(trades, markets, threshold))


def _running_order() -> list[Column]:
    names = ("transaction_hash", "log_index", "token", "buyer", "profit_units")
    return [F.desc("block_number"), *[F.col(name).asc() for name in names]]


def running_profit(rows: DataFrame) -> DataFrame:
    """Add ``profit`` and ``running_profit`` per user in descending block order.

    Rows are range-partitioned and sorted by user and order, and each task adds up its own stretch of them as
    they pass, so no user's history is sorted in one task, however active the user is. Only users
    who go on in a later slice, at most one per slice, need what earlier slices hold of them.
    """
    spark = rows.sparkSession
    order = [F.col("user"), *_running_order(), F.col("_tie")]
    numbered = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(spread_width(spark), *order).sortWithinPartitions(*order)
    sliced = ranged.drop("_tie").withColumn("slice", F.spark_partition_id())
    # The cut points are sampled, so the slices are stored before use.
    summed = cut_lineage(sliced.mapInArrow(_summed_by_user, T.StructType([*sliced.schema, T.StructField("so_far", T.LongType())])))
    totals = summed.groupBy("user", "slice").agg(F.sum("profit_units").alias("slice_units"))
    earlier = W.partitionBy("user").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select("user", "slice", F.sum("slice_units").over(earlier).alias("before"))
    # One row per slice at most; its stored size lets Spark broadcast it.
    offsets = cut_lineage(before.where(F.col("before").isNotNull()))
    return (
        summed.join(offsets, ["user", "slice"], "left")
        .withColumns(
            {
                "profit": F.col("profit_units") / fills.UNIT,
                "running_profit": (F.coalesce("before", F.lit(0).cast("long")) + F.col("so_far")) / fills.UNIT,
            }
        )
        .drop("slice", "before", "so_far", "profit_units")
    )


def _summed_by_user(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the running sum of ``profit_units`` within each stretch of rows of one user."""
    last, carried = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        users = batch.column("user")
        units = batch.column("profit_units").to_numpy(zero_copy_only=False)
        fresh = np.ones(len(units), bool)
        fresh[1:] = pc.not_equal(users.slice(1), users.slice(0, len(users) - 1)).to_numpy(zero_copy_only=False)
        fresh[0] = users[0].as_py() != last
        total = np.cumsum(units)
        if np.abs(np.cumsum(units.astype(np.float64))).max() + abs(carried) > 9e18:
            raise OverflowError("a running profit exceeds 64 bits")
        starts = np.flatnonzero(fresh)
        stretch = np.cumsum(fresh) - 1
        base = np.concatenate([[-carried], (total - units)[starts]])
        so_far = total - base[stretch + 1]
        last, carried = users[len(users) - 1].as_py(), int(so_far[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(so_far)], names=[*batch.schema.names, "so_far"])


def total_profit(rows: DataFrame) -> DataFrame:
    """Sum of profit per user over the profit rows."""
    total = long_sum(F.col("profit_units")).cast("double") / fills.UNIT
    return rows.groupBy("user").agg(total.alias("total_profit"))
