"""Markets, trades and blocks derived from a star-schema sample dataset.

Parts become markets, order lines become fills, customers and suppliers become
makers and takers. The derivation is a plain projection over one join, so it grows
with the given tables and prunes to the columns a query needs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fillscope.functions.times import utc_time

# Question templates by part number modulo 12 (none for the last),
# and outcome prices by part number modulo 5.
QUESTIONS = (
    "Will bitcoin close above $100k?",
    "Trump to win the election?",
    "Lakers NBA championship?",
    "Fed interest rate cut?",
    "Oscars best movie?",
    "Will it snow in Paris?",
    "Whether Kardashian album tops?",
    "Arsenal goals over 2?",
    "Russia ceasefire?",
    "Inflation above 3?",
    "NHL final goals?",
)
OUTCOME_PRICES = (
    '["1","0"]',
    '["0","1"]',
    '["0.995","0.005"]',
    '["0.9965","0.0035"]',
    '["0.62","0.38"]',
)
FIRST_TOKEN = 1_000_000
EPOCH_1995 = 788_918_400


def _choose(index: Column, values: tuple[str, ...]) -> Column:
    chosen = F.lit(None).cast("string")
    for position, value in enumerate(values):
        chosen = F.when(index == position, F.lit(value)).otherwise(chosen)
    return chosen


def _address(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 8, "0"))


def derive_markets(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    yes_token = (F.lit(FIRST_TOKEN) + 2 * key).cast("string")
    no_token = (F.lit(FIRST_TOKEN) + 2 * key + 1).cast("string")
    return part.select(
        key.alias("market_id"),
        F.concat(_choose(key % 12, QUESTIONS), F.lit(" #"), key.cast("string")).alias("question"),
        F.concat(F.lit('["'), yes_token, F.lit('","'), no_token, F.lit('"]')).alias("clob_token_ids"),
        _choose(key % 5, OUTCOME_PRICES).alias("outcome_prices"),
        (F.col("p_retailprice") * F.col("p_size") * 1000).alias("volume"),
        F.concat(F.lit("0xmm"), (key % 97).cast("string")).alias("market_maker_address"),
        yes_token.alias("condition_id"),
    )


def derive_trades(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    days = F.datediff(F.col("l_shipdate"), F.lit("1995-01-01").cast("date"))
    token = F.when(F.col("l_partkey") % 211 == 0, F.lit("999")).otherwise(
        (F.lit(FIRST_TOKEN) + 2 * F.col("l_partkey") + line % 2).cast("string")
    )
    quantity = F.col("l_quantity").cast("long")
    contracts = F.when(order % 499 == 0, F.lit(0).cast("long")).otherwise(
        (F.col("l_quantity") * 1_000_000).cast("long")
    )
    dollars = quantity * (F.lit(1) + (order * 7 + line * 13) % 98) * 10_000
    maker_sells = F.col("l_returnflag") == "A"
    taker = F.when(order % 503 == 0, F.lit(None).cast("string")).otherwise(
        F.when(line == 1, _address("0xC", F.col("l_suppkey"))).otherwise(
            _address("0xS", F.col("l_suppkey"))
        )
    )
    dollar_asset = F.lit("0")
    return lineitem.join(orders, order == F.col("o_orderkey")).select(
        F.concat(F.lit("0x"), F.md5(order.cast("string"))).alias("transaction_hash"),
        line.alias("log_index"),
        (days.cast("long") * 43_200 + order % 43_200).alias("block_number"),
        _address("0xC", F.col("o_custkey")).alias("maker"),
        taker.alias("taker"),
        F.when(maker_sells, token).otherwise(dollar_asset).alias("maker_asset_id"),
        F.when(maker_sells, dollar_asset).otherwise(token).alias("taker_asset_id"),
        F.when(maker_sells, contracts).otherwise(dollars).alias("maker_amount"),
        F.when(maker_sells, dollars).otherwise(contracts).alias("taker_amount"),
    )


def derive_blocks(trades: DataFrame) -> DataFrame:
    # The time comes from an aggregate value, not from the grouping key: a filter on
    # it then stays above the aggregate instead of running on every trade.
    time = utc_time(F.lit(EPOCH_1995) + 2 * F.col("height")).cast("string")
    text = F.concat(F.substring(time, 1, 10), F.lit("T"), F.substring(time, 12, 8), F.lit("Z"))
    return (
        trades.filter(F.col("block_number") % 997 != 0)
        .groupBy("block_number")
        .agg(F.max("block_number").alias("height"))
        .select("block_number", text.alias("timestamp"))
    )


class SampleTables:
    """The three input tables over one dataset folder, built lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def markets(self) -> DataFrame:
        return derive_markets(self.table("part"))

    @cached_property
    def trades(self) -> DataFrame:
        return derive_trades(self.table("lineitem"), self.table("orders"))

    @cached_property
    def blocks(self) -> DataFrame:
        return derive_blocks(self.trades)
