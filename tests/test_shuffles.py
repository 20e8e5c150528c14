"""How often whole rows move, and what stored stages leave behind."""

from __future__ import annotations

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fillscope import scale
from fillscope.functions.fills import DOLLAR_ASSET
from fillscope.operators import categories


@pytest.fixture
def no_broadcast(spark):
    keys = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {key: spark.conf.get(key) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def exchanges_with(df, column):
    """Exchanges of the plan that move a column."""
    found, rest = 0, [df._jdf.queryExecution().executedPlan().executedPlan()]
    while rest:
        node = rest.pop()
        names = {node.output().apply(i).name() for i in range(node.output().size())}
        found += node.nodeName() == "Exchange" and column in names
        rest += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_a_history_moves_whole_fills_once(spark, sample, no_broadcast):
    past = sample.trades.select(F.col("maker").alias("trader"), F.lit("Politics").alias("primary_category"))
    with scale.stages(spark):
        found = categories.trade_categories(sample.trades, sample.markets, past)
        assert exchanges_with(found, "taker_amount") == 1


def test_fills_paid_in_dollars_need_no_second_lookup(spark, sample, no_broadcast):
    paid = spark.sql("SELECT * FROM VALUES ('0xa', '0', '1000002', 5), ('0xb', '1000003', '0', 6) AS t(maker, maker_asset_id, taker_asset_id, taker_amount)")
    found = categories.trade_categories(paid, sample.markets)
    assert exchanges_with(found, "taker_amount") == 1
    assert found.where("cat_by_token IS NOT NULL").count() == 2


@pytest.mark.parametrize("hashed", [True, False])
def test_categories_by_history_equal_a_plain_lookup(spark, no_broadcast, hashed):
    markets = spark.createDataFrame(
        [('["T1","T2"]', "Will bitcoin rise?", "m", "c1"), ('["U1","0"]', "Oscars night?", "m", "c2"), ('["",null]', "Lakers NBA?", "m", "c3")],
        "clob_token_ids string, question string, market_maker_address string, condition_id string",
    )
    known = {"t1": "Crypto", "t2": "Crypto", "u1": "Pop Culture", "": "Sports"}
    past = {"0xa": "Politics", "0xb": "Sports"}
    history = spark.createDataFrame([("0xA", "Economics"), ("0xa", "Politics"), ("0xB", "Sports"), (None, "Crypto"), ("0xC", None)], "trader string, primary_category string")
    assets = ["0", "T1", "t2", "U1", "x", "", None]
    rows = [(tx, i, maker, a, b) for tx in ("h1", "h2", None) for i, maker in enumerate(("0xa", "0xA", "0xB", "0xC", "0xD", None)) for a in assets for b in assets]
    rows += rows[:60]
    fills = spark.createDataFrame(rows, "transaction_hash string, log_index int, maker string, maker_asset_id string, taker_asset_id string")
    fills = fills if hashed else fills.drop("transaction_hash")

    def expected(row):
        *_, maker, a, b = row
        lookup = lambda asset: None if asset in (None, DOLLAR_ASSET) else known.get(asset.lower())
        token, own = lookup(b) or lookup(a), past.get(maker.lower()) if maker else None
        return (*(row if hashed else row[1:]), token, own, token or own or "Other/Misc")

    with scale.stages(spark):
        found = categories.trade_categories(fills, markets, history)
        assert found.columns == [*fills.columns, "cat_by_token", "cat_by_history", "category"]
        assert Counter(map(tuple, found.collect())) == Counter(map(expected, rows))


def test_stored_stages_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = lambda: {disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())}
    before, setting = names(), spark.conf.get(scale.SHUFFLE_CLEANUP, "false")
    with scale.stages(spark):
        stored = scale.cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
        for _ in range(50):
            left = {name for name in names() - before if name.startswith("shuffle_")}
            if not left:
                break
            time.sleep(0.2)
        assert not left
        assert stored.count() == 7
    assert spark.conf.get(scale.SHUFFLE_CLEANUP, "false") == setting
