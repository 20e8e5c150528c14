"""Declared table schemas and the required-column check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_text, _long, _int, _double, _bool = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.BooleanType(),
)

MARKETS = _struct(
    question=_text,
    clob_token_ids=_text,
    outcome_prices=_text,
    volume=_double,
    market_maker_address=_text,
    condition_id=_text,
)

# Asset ids are 256-bit numbers kept as text; reading them as numbers loses digits.
TRADES = _struct(
    transaction_hash=_text,
    log_index=_int,
    block_number=_long,
    maker=_text,
    taker=_text,
    maker_asset_id=_text,
    taker_asset_id=_text,
    maker_amount=_long,
    taker_amount=_long,
)

BLOCKS = _struct(block_number=_long, timestamp=_text)

MEASURES = (
    "win_rate",
    "avg_trade_size",
    "total_trade_volume",
    "total_trade_number",
    "frequency",
    "net_gains_loss",
    "avg_odds",
    "profit_per_trade",
)
BUYS_ONLY = "_ignore_sales"
STAT_COLUMNS = MEASURES + tuple(name + BUYS_ONLY for name in MEASURES)

TRADER_STATS = _struct(
    trader=_text,
    **{name: _long if name.startswith("total_trade_number") else _double for name in STAT_COLUMNS},
)

UPDATED_TRADER_STATS = _struct(primary_category=_text, **{f.name: f.dataType for f in TRADER_STATS})

UPDATED_TRADES = T.StructType(
    TRADES.fields
    + _struct(cat_by_token=_text, cat_by_history=_text, category=_text).fields
)

# The category labels, in the alphabetical order of their flag columns.
CATEGORIES = ("Crypto", "Economics", "Other/Misc", "Politics", "Pop Culture", "Sports")
DEFAULT_CATEGORY = "Other/Misc"
FLAG_COLUMNS = tuple(f"category_{name}" for name in CATEGORIES)

CLUSTERED_TRADERS = T.StructType(
    UPDATED_TRADER_STATS.fields
    + _struct(
        **{name: _bool for name in FLAG_COLUMNS},
        kmeans_cluster=_int,
        proj_1=_double,
        proj_2=_double,
    ).fields
)


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> DataFrame:
    """Fail early, naming every absent column."""
    absent = sorted(set(names) - set(df.columns))
    if absent:
        raise ValueError(f"{what} lacks required columns: {', '.join(absent)}")
    return df
