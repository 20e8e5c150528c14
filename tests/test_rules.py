"""Hand-made cases for each rule."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fillscope import schemas
from fillscope.functions.categories import HISTOGRAM_RULES, categorize, decode_one_hot
from fillscope.functions.fills import implied_price
from fillscope.functions import numeric
from fillscope.functions.numeric import finite_or_zero, half_even, signed_log
from fillscope.functions.times import block_epoch, utc_time
from fillscope.operators import categories, markets, positions, stats

M = 1_000_000


def market(spark, *rows):
    """Rows of (condition, yes token, no token, yes price, no price, question)."""
    return spark.createDataFrame(
        [
            (q, f'["{yes}","{no}"]', f'["{p}","{r}"]', 1.0, "mm", condition)
            for condition, yes, no, p, r, q in rows
        ],
        schemas.MARKETS,
    )


def trade(maker, taker, maker_asset, taker_asset, maker_amount, taker_amount, block=1, log=0):
    return ("0xt", log, block, maker, taker, maker_asset, taker_asset, maker_amount, taker_amount)


def trades(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.TRADES)


def blocks(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.BLOCKS)


@pytest.fixture(scope="module")
def one_market(spark):
    return market(spark, ("c", "11", "12", "1", "0", "Will it?"))


@pytest.fixture(scope="module")
def block_one(spark):
    return blocks(spark, (1, "2024-01-01T00:00:00Z"), (2, "not a time"))


def test_price_boundary(spark):
    rows = market(
        spark,
        ("a", "1", "2", "0.995", "0.005", "q"),
        ("b", "3", "4", "0.9951", "0.0049", "q"),
        ("c", "5", "6", "0", "1", "q"),
    )
    found = {r.token: (r.implied_outcome, r.resolved, r.token_type) for r in markets.tokens(rows).collect()}
    assert found == {
        "1": (None, False, True),
        "2": (None, False, False),
        "3": (True, True, True),
        "4": (False, True, False),
        "5": (False, True, True),
        "6": (True, True, False),
    }


def test_repeated_token_keeps_last_market_and_prefers_yes(spark):
    rows = market(spark, ("a", "1", "2", "1", "0", "old"), ("b", "3", "1", "1", "0", "new"))
    found = {r.token: r for r in markets.token_dimension(rows).collect()}
    assert found["1"].is_yes_token is True
    assert found["1"].question == "old"
    assert found["1"].implied_outcome is False


@pytest.mark.parametrize(
    "fill, outcome, expected",
    [
        (("0", "11", 40 * M, 100 * M), "maker", (True, 0.4, True, 60.0)),
        (("0", "12", 40 * M, 100 * M), "maker", (True, 0.4, False, -40.0)),
        (("11", "0", 100 * M, 40 * M), "maker", (False, 0.4, False, -60.0)),
        (("12", "0", 100 * M, 40 * M), "maker", (False, 0.4, True, 40.0)),
        (("0", "11", 5 * M, 0), "maker", (True, 0.0, True, -5.0)),
        (("11", "0", 100 * M, 40 * M), "taker", (True, 0.4, True, 60.0)),
    ],
)
def test_position_rules(spark, one_market, block_one, fill, outcome, expected):
    found = positions.positions(trades(spark, trade("maker", "taker", *fill)), block_one, one_market)
    row = found.filter(F.col("trader") == outcome).first()
    assert (row.bought_contract, row.odds, row.won, row.profit) == expected
    assert str(row.time) == "2024-01-01 00:00:00"


def test_maker_and_taker_profit_cancel(sample):
    units = positions.position_units(sample.trades, sample.blocks, sample.markets)
    unbalanced = (
        units.groupBy("transaction_hash", "log_index", "block_number", "token", "dollar_units", "contract_units")
        .agg(F.sum("profit_units").alias("p"), F.count("*").alias("n"), F.sum(F.col("is_maker").cast("int")).alias("m"))
        .filter("n = 2 * m and p <> 0")
    )
    assert unbalanced.count() == 0


def test_self_trade_is_two_maker_rows(spark, one_market, block_one):
    found = positions.positions(trades(spark, trade("a", "a", "0", "11", M, 2 * M)), block_one, one_market)
    assert [(r.trader, r.is_maker, r.bought_contract) for r in found.collect()] == [("a", True, True)] * 2


def test_two_tokens_are_not_a_buy(spark, one_market, block_one):
    found = positions.positions(trades(spark, trade("a", "b", "11", "12", M, M)), block_one, one_market)
    assert {r.bought_contract for r in found.collect()} == {False}


def test_unusable_fills_are_left_out(spark, block_one):
    listed = market(spark, ("c", "11", "12", "1", "0", "q"), ("d", "13", "14", "0.6", "0.4", "q"))
    rows = trades(
        spark,
        trade("a", "b", "0", "13", M, M),
        trade("a", "b", "0", "99", M, M),
        trade("a", "b", "0", "11", M, M, block=7),
        trade("a", "b", "0", "11", M, M, block=2),
        trade("a", None, "0", "11", M, M),
        trade("a", "b", None, "11", M, M),
    )
    found = positions.positions(rows, block_one, listed).collect()
    assert [(r.trader, r.token) for r in found] == [("a", "11")]
    pnl = positions.user_pnl(rows, listed).filter("token = '13' and user = 'a'").first()
    assert pnl.profit == -1.0


def test_frequency_and_missing_buys(spark, one_market):
    times = blocks(spark, (1, "2024-01-01T00:00:00Z"), (2, "2024-01-02T23:00:00Z"))
    rows = trades(
        spark,
        trade("twice", "seller", "0", "11", M, M, block=1),
        trade("twice", "seller", "0", "11", M, M, block=2),
        trade("once", None, "0", "11", M, M),
    )
    found = {r.trader: r for r in stats.trader_stats(rows, times, one_market).collect()}
    assert set(found) == {"twice", "once"}
    assert found["twice"].frequency == 1.0
    assert found["once"].frequency == 0.0


def test_stats_do_not_depend_on_partitioning(sample):
    one = stats.trader_stats(sample.trades, sample.blocks, sample.markets).collect()
    other = stats.trader_stats(
        sample.trades.repartition(13), sample.blocks.repartition(3), sample.markets.repartition(5)
    ).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))


@pytest.mark.parametrize(
    "question, category, older",
    [
        ("bitcoin election", "Crypto", "Crypto"),
        ("Inflation high?", "Sports", "Sports"),
        ("You must", "Politics", "Other/Misc"),
        ("Arsenal?", "Sports", "Other/Misc"),
        ("costs $5", "Economics", "Economics"),
        ("a COACHELLA set", "Pop Culture", "Pop Culture"),
        (None, "Other/Misc", "Other/Misc"),
    ],
)
def test_categories(spark, question, category, older):
    row = spark.createDataFrame([(question,)], "question string").select(
        categorize(F.col("question")), categorize(F.col("question"), HISTOGRAM_RULES)
    ).first()
    assert tuple(row) == (category, older)


def test_modal_tie_takes_the_first_name(spark):
    rows = spark.createDataFrame(
        [("a", "Sports"), ("a", "Crypto"), ("a", "Sports"), ("a", "Crypto")], "maker string, category string"
    )
    assert categories.trader_primary_category(rows).first().primary_category == "Crypto"


def test_history_fills_in_and_is_replaced(spark, one_market):
    rows = trades(spark, trade("0xA", "b", "0", "99", M, M), trade("0xB", "b", "0", "11", M, M))
    history = spark.createDataFrame([("0xa", "Politics")], "trader string, primary_category string")
    found = {r.maker: r.category for r in categories.trade_categories(rows, one_market, history).collect()}
    assert found == {"0xA": "Politics", "0xB": "Other/Misc"}
    fresh = spark.createDataFrame([("0xa", "Crypto")], "trader string, primary_category string")
    updated = categories.updated_trader_stats(history, fresh)
    assert updated.columns == ["primary_category", "trader"]
    assert updated.first().primary_category == "Crypto"


def test_implied_price(spark):
    rows = spark.createDataFrame([(0, 0), (1, 0), (1, 1)], "m long, t long")
    assert [r[0] for r in rows.select(implied_price(F.col("m"), F.col("t"))).collect()] == [None, 100.0, 50.0]


def test_number_rules(spark):
    row = spark.range(1).select(
        half_even(F.lit(0.575), 2),
        finite_or_zero(F.lit(float("inf"))),
        finite_or_zero(F.lit(float("nan"))),
        finite_or_zero(F.lit(None).cast("double")),
        signed_log(F.lit(-1.0)),
    ).first()
    assert tuple(row[:4]) == (0.57, 0.0, 0.0, 0.0)
    assert row[4] == pytest.approx(-0.6931471805599453)


def test_one_hot_without_flag(spark):
    flags = [F.lit(False).alias(name) for name in schemas.FLAG_COLUMNS]
    assert spark.range(1).select(*flags).select(decode_one_hot()).first()[0] == "Other/Misc"


def test_times_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.range(1).select(
            block_epoch(F.lit("2024-03-10T02:30:00Z")),
            utc_time(F.lit(1710037800)).cast("string"),
            block_epoch(F.lit("2024-03-10 02:30:00")),
            block_epoch(F.lit("2024-13-10T02:30:00Z")),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (1710037800, "2024-03-10 02:30:00", None, None)


def test_exact_sums_of_longs_and_ratios(spark):
    values = [0, 1, -1, 2**62, -(2**62), 2**42, -(2**42) - 1, 2**21, 123456789012345, -987654321098765] + [2**62] * 9
    ratios = [0.0, 0.5, -0.25, 1e-9, 1234567.000000001, 9e15, -7.1e12, 1 / 3]
    rows = [(v, None) for v in values] + [(None, r) for r in ratios] + [(None, None)]
    frame = spark.createDataFrame(rows, "v long, r double").repartition(3)
    found = frame.agg(
        numeric.long_sum(F.col("v")).alias("v"),
        numeric.long_sum(F.col("v"), F.col("v") < 0).alias("below"),
        numeric.grid_sum(F.col("r")).alias("r"),
        numeric.long_sum(F.col("v"), F.lit(False)).alias("none"),
    ).first()
    assert int(found.v) == sum(values) and int(found.below) == sum(v for v in values if v < 0)
    assert int(found.r) == sum(round(r * 1e9) for r in ratios) and found.none is None


def test_category_lookups_of_dollar_and_token_fills(spark):
    markets = spark.createDataFrame(
        [('["T1","T2"]', "Will bitcoin rise?", "m", "c1"), ('["U1","0"]', "Oscars night?", "m", "c2")],
        "clob_token_ids string, question string, market_maker_address string, condition_id string",
    )
    pairs = [("0", "t1"), ("T2", "0"), ("T1", "U1"), ("U1", "x"), ("x", "U1"), ("x", "y"), ("0", "0"), (None, "T1"), ("T1", None), (None, None)]
    fills = spark.createDataFrame([(i, "m", *p) for i, p in enumerate(pairs)], "log_index int, maker string, maker_asset_id string, taker_asset_id string")
    found = {r.log_index: r.cat_by_token for r in categories.trade_categories(fills, markets).collect()}
    crypto, pop = "Crypto", "Pop Culture"
    assert [found[i] for i in range(10)] == [crypto, crypto, pop, pop, pop, None, None, crypto, crypto, None]
