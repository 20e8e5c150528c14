"""Trader counts, the deterministic trader sample, and the trades it keeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillscope.functions.numeric import hash_bucket
from fillscope.scale import cut_lineage, lookup_join

MIN_TRADES = 100
SAMPLE_RATE = 100


def both_sides(trades: DataFrame) -> DataFrame:
    """One ``trader`` row per known party of each trade, in one scan."""
    return trades.select(F.explode(F.array("maker", "taker")).alias("trader")).filter(
        F.col("trader").isNotNull()
    )


def trader_counts(trades: DataFrame) -> DataFrame:
    return both_sides(trades).groupBy("trader").agg(F.count(F.lit(1)).alias("total_trades"))


def active_traders(counts: DataFrame, min_trades: int = MIN_TRADES) -> DataFrame:
    return counts.filter(F.col("total_trades") >= min_trades)


def in_sample(trader: Column, rate: int = SAMPLE_RATE) -> Column:
    """Whether the address falls into the sample of about one in ``rate``."""
    return hash_bucket(trader, rate) == 0


def sample_traders(
    trades: DataFrame, rate: int = SAMPLE_RATE, min_trades: int = MIN_TRADES
) -> DataFrame:
    """Traders in the hash sample with enough trades.

    The hash test needs no counts, so it runs before the shuffle and only about
    one address in ``rate`` is counted at all.
    """
    kept = both_sides(trades).filter(in_sample(F.col("trader"), rate))
    counts = kept.groupBy("trader").agg(F.count(F.lit(1)).alias("total_trades"))
    return active_traders(counts, min_trades).select("trader")


def trades_of(trades: DataFrame, traders: DataFrame) -> DataFrame:
    """Trades whose maker or taker is in ``traders`` (unique addresses).

    Two left joins instead of two IN subqueries: adaptive execution can split a hot
    maker in a left join, not in an existence join.
    """
    makers = traders.select(F.col("trader").alias("maker"), F.lit(True).alias("maker_kept"))
    takers = traders.select(F.col("trader").alias("taker"), F.lit(True).alias("taker_kept"))
    marked = lookup_join(lookup_join(trades, makers, "maker", "left"), takers, "taker", "left")
    return marked.filter(F.col("maker_kept") | F.col("taker_kept")).select(*trades.columns)


def sample_trades(
    trades: DataFrame, rate: int = SAMPLE_RATE, min_trades: int = MIN_TRADES
) -> DataFrame:
    """All trades of the sampled traders.

    Rows with neither party in the hash sample cannot qualify; dropping them first
    leaves about ``2 / rate`` of the trades for the joins. The sampled addresses are
    stored once, so that both joins know their true size.
    """
    candidates = trades.filter(
        in_sample(F.col("maker"), rate) | in_sample(F.col("taker"), rate)
    )
    return trades_of(candidates, cut_lineage(sample_traders(trades, rate, min_trades)))


def trades_by_maker(trades: DataFrame, more_than: int = 100) -> DataFrame:
    counts = trades.groupBy("maker").agg(F.count(F.lit(1)).alias("trade_count"))
    return counts.filter(F.col("trade_count") > more_than)


def exact_address(trades: DataFrame, target: str) -> DataFrame:
    """One maker address equal to ``target`` up to case; no row without one."""
    return trades.filter(F.upper("maker") == target.upper()).select("maker").limit(1)


def exact_addresses(trades: DataFrame, targets: DataFrame) -> DataFrame:
    """The same lookup for many targets at once, NULL where none matches.

    The makers are reduced to one row per lower-case address before the join.
    """
    known = trades.groupBy(F.lower("maker").alias("address_key")).agg(F.min("maker").alias("maker"))
    return (
        targets.select("target", F.lower("target").alias("address_key"))
        .join(known, "address_key", "left")
        .select("target", "maker")
    )


def trades_with_party(trades: DataFrame, address: str) -> DataFrame:
    """Trades of one address on either side; the test reaches the file scan."""
    return trades.filter((F.col("maker") == address) | (F.col("taker") == address))


def count_trades_of(trades: DataFrame, address: str) -> DataFrame:
    return trades_with_party(trades, address).agg(F.count(F.lit(1)).alias("n"))
