"""Expressions on one fill: which asset, who buys, at what price, with what result.

Asset ``'0'`` is the dollar stablecoin, every other id an outcome token. Amounts
are integers in units of one millionth.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOLLAR_ASSET = "0"
UNIT = 1e6


def maker_pays_dollars() -> Column:
    """True, False, or NULL for an unknown asset."""
    return F.col("maker_asset_id") == DOLLAR_ASSET


def traded_token() -> Column:
    return F.when(maker_pays_dollars(), F.col("taker_asset_id")).otherwise(F.col("maker_asset_id"))


def dollar_units() -> Column:
    return F.when(maker_pays_dollars(), F.col("maker_amount")).otherwise(F.col("taker_amount"))


def contract_units() -> Column:
    return F.when(maker_pays_dollars(), F.col("taker_amount")).otherwise(F.col("maker_amount"))


def fill_id() -> Column:
    """``hash:index``; NULL when either part is NULL."""
    return F.concat(F.col("transaction_hash"), F.lit(":"), F.col("log_index").cast("string"))


def payoff_units(outcome: Column, dollars: Column, contracts: Column, bought: Column) -> Column:
    """Profit in millionths: a buyer gets the contracts if the token pays, less the
    dollars; a seller the opposite."""
    received = F.when(outcome, contracts).otherwise(F.lit(0).cast("long"))
    return F.when(bought, received - dollars).otherwise(dollars - received)


def implied_price(maker_amount: Column, taker_amount: Column) -> Column:
    """Maker share of the exchanged amounts in percent, NULL without amounts."""
    maker, taker = maker_amount.cast("double"), taker_amount.cast("double")
    return F.when(maker + taker > 0, F.lit(100.0) * maker / (maker + taker))
