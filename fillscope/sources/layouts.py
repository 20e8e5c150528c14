"""Stored layouts that let later queries skip shuffles and files.

* Bucketed fills and tokens meet without moving the fills. Both are bucketed by token and a salt, and every token is
  stored once per salt, so that a token with a third of all fills fills as many buckets as there are salts.
* The address index holds the sides of all fills, sorted by lower-case address, with Parquet's ranges and
  bloom filters: a lookup opens the row groups of one address.
* Fills by day are partitioned by the UTC day of their block, so that a query over some blocks reads their days only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fillscope.functions import fills
from fillscope.functions.times import block_epoch, utc_time
from fillscope.operators.markets import DEFAULT_THRESHOLD, token_dimension
from fillscope.operators.positions import in_dollars, units_of
from fillscope.scale import shared_folder, spread_width

SALTS = 16
# Files of a day, so that a busy day is written and read by several tasks.
DAY_FILES = 8
# Row groups of the address index: small ones, since a lookup wants few rows.
INDEX_GROUP_BYTES = 4 << 20
UNKNOWN_DAY = "unknown"


def _salt(salts: int) -> Column:
    return F.pmod(F.xxhash64("transaction_hash", "log_index"), F.lit(salts)).cast("int").alias("salt")


def _timed(trades: DataFrame, blocks: DataFrame) -> DataFrame:
    """Trades with the epoch of their block, NULL for an unknown block or time."""
    epochs = blocks.select("block_number", block_epoch(F.col("timestamp")).alias("epoch"))
    return trades.join(epochs, "block_number", "left")


def _save_bucketed(df: DataFrame, name: str, buckets: int, path: str | None) -> None:
    """Each bucket is one partition and so one file: Spark's hash decides both."""
    target = path or shared_folder(df.sparkSession, name)
    (
        df.repartition(buckets, "token", "salt")
        .write.mode("overwrite")
        .bucketBy(buckets, "token", "salt")
        .sortBy("token", "salt")
        .option("path", target)
        .saveAsTable(name)
    )


def store_bucketed(
    trades: DataFrame,
    blocks: DataFrame,
    markets: DataFrame,
    prefix: str = "bucketed",
    buckets: int | None = None,
    salts: int = SALTS,
    threshold: float = DEFAULT_THRESHOLD,
) -> tuple[str, str]:
    """Store fills with their block time, and tokens with their outcome; returns the tables' names."""
    count = buckets or spread_width(trades.sparkSession)
    names = f"{prefix}_fills", f"{prefix}_tokens"
    facts = _timed(trades, blocks).select(
        "transaction_hash",
        "log_index",
        "block_number",
        "maker",
        "taker",
        "maker_asset_id",
        "taker_asset_id",
        "epoch",
        fills.traded_token().alias("token"),
        fills.dollar_units().alias("dollar_units"),
        fills.contract_units().alias("contract_units"),
        _salt(salts),
    )
    _save_bucketed(facts, names[0], count, None)
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    _save_bucketed(token_dimension(markets, threshold).select("*", every_salt), names[1], count, None)
    return names


def bucketed_positions(spark: SparkSession, fills_name: str, tokens_name: str) -> DataFrame:
    """Positions from the stored tables: the fills are read where they lie, without an exchange."""
    resolved = spark.table(tokens_name).filter(F.col("implied_outcome").isNotNull())
    timed = spark.table(fills_name).filter(F.col("epoch").isNotNull())
    return in_dollars(units_of(timed.join(resolved, ["token", "salt"]).drop("salt")))


def store_address_index(trades: DataFrame, path: str, files: int | None = None) -> None:
    """Write one row per known side, sorted by lower-case address.

    A fill between two spellings of one address is one row with both roles. Ranges end inside a busy
    address too, since its fills are ordered by their hash.
    """
    sides = F.array(
        F.struct(F.col("maker").alias("address"), F.lit("maker").alias("role")),
        F.struct(F.col("taker").alias("address"), F.lit("taker").alias("role")),
    )
    same = F.lower("maker").eqNullSafe(F.lower("taker"))
    rows = trades.select("*", F.inline(F.when(same, F.array(F.struct(F.col("maker").alias("address"), F.lit("both").alias("role")))).otherwise(sides)))
    keyed = rows.filter(F.col("address").isNotNull()).select(F.lower("address").alias("address_key"), *[c for c in rows.columns if c != "address_key"])
    order = ["address_key", "transaction_hash", "log_index"]
    (
        keyed.repartitionByRange(files or spread_width(trades.sparkSession), *order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("parquet.block.size", INDEX_GROUP_BYTES)
        .option("parquet.bloom.filter.enabled#address_key", "true")
        .parquet(path)
    )


def indexed_trades(spark: SparkSession, path: str, address: str) -> DataFrame:
    """Trades of one address on either side, in whatever case it is written; NULL has none."""
    key = address.lower() if address is not None else None
    return spark.read.parquet(path).filter(F.col("address_key") == F.lit(key).cast("string"))


def indexed_address(spark: SparkSession, path: str, target: str) -> DataFrame:
    """A maker address equal to ``target`` up to case; no row without one."""
    made = indexed_trades(spark, path, target).filter(F.col("role") != "taker")
    return made.select("maker").limit(1)


def _day(epoch: Column) -> Column:
    """The UTC day as text; its own value where the time is unknown."""
    return F.coalesce(F.substring(utc_time(epoch).cast("string"), 1, 10), F.lit(UNKNOWN_DAY))


def store_by_day(trades: DataFrame, blocks: DataFrame, path: str, files: int = DAY_FILES) -> None:
    """Write trades partitioned by day; a day's rows are dealt to ``files`` tasks."""
    dated = _timed(trades, blocks).withColumn("day", _day(F.col("epoch"))).drop("epoch")
    dealt = F.pmod(F.xxhash64("transaction_hash", "log_index"), F.lit(files))
    dated.repartition(F.col("day"), dealt).write.mode("overwrite").partitionBy("day").parquet(path)


def trades_of_blocks(spark: SparkSession, path: str, blocks: DataFrame) -> DataFrame:
    """Stored trades of the given blocks, with their block time; only the days of these blocks are read.

    The days, at most some ten thousand in a century, are broadcast; they prune the partitions when the query runs.
    """
    epoch = block_epoch(F.col("timestamp"))
    times = blocks.select("block_number", F.col("timestamp").alias("block_time"), _day(epoch).alias("day"))
    facts = spark.read.parquet(path).withColumn("day", F.col("day").cast("string"))
    near = facts.join(F.broadcast(times.select("day").distinct()), "day", "left_semi")
    return near.drop("day").join(times.drop("day"), "block_number")
