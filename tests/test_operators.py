"""Operators against brute force, and their invariants."""

from __future__ import annotations

import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from fillscope import scale, schemas
from fillscope.functions.numeric import exact_sum, grid_mean, rounded_away
from fillscope.operators import categories, clusters, features, points, positions, quantiles, subset
from fillscope.plans import registry
from fillscope.streaming.trader_counts import start_counts, read_counts, stream_trader_counts
from test_rules import market, trade, trades


def test_counts_add_up(sample):
    total = subset.trader_counts(sample.trades).agg(F.sum("total_trades")).first()[0]
    known = sample.trades.agg(F.count("maker") + F.count("taker")).first()[0]
    assert total == known


def test_stream_equals_batch_over_batches_and_restarts(spark, sample, tmp_path):
    source = str(tmp_path / "trades")
    sample.trades.repartition(6).write.parquet(source)

    def stream():
        return (
            spark.readStream.schema(sample.trades.schema).option("maxFilesPerTrigger", 2).parquet(source)
        )

    checkpoint = str(tmp_path / "checkpoint")
    stream_trader_counts(stream(), checkpoint)
    sample.trades.limit(500).write.mode("append").parquet(source)
    query = start_counts(stream(), checkpoint)
    query.awaitTermination()
    kept = read_counts(spark, checkpoint)
    batch = subset.trader_counts(spark.read.parquet(source))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, batch.collect()))


def test_sample_is_contained(sample):
    kept = subset.sample_trades(sample.trades, 5, 20)
    assert kept.exceptAll(sample.trades).count() == 0
    traders = {r.trader for r in subset.sample_traders(sample.trades, 5, 20).collect()}
    assert all(r.maker in traders or r.taker in traders for r in kept.collect())


def test_exact_address(sample):
    assert subset.exact_address(sample.trades, "0xc00000042").first().maker == "0xC00000042"
    assert subset.exact_address(sample.trades, "nobody").count() == 0


def test_running_profit_of_one_dominant_user(spark):
    draw = random.Random(7)
    rows = [
        ("hot" if i % 10 else f"u{i % 7}", draw.randrange(40), f"t{draw.randrange(5)}", i % 3, "11", True, draw.randrange(-99, 99))
        for i in range(3000)
    ]
    names = "user string, block_number long, transaction_hash string, log_index int, token string, buyer boolean, profit_units long"
    found = positions.running_profit(spark.createDataFrame(rows, names))
    expected, so_far = [], {}
    for user, block, tx, log, token, buyer, units in sorted(
        rows, key=lambda r: (r[0], -r[1], r[2], r[3], r[4], r[5], r[6])
    ):
        so_far[user] = so_far.get(user, 0) + units
        expected.append((user, block, tx, log, units / 1e6, so_far[user] / 1e6))
    actual = [
        (r.user, r.block_number, r.transaction_hash, r.log_index, r.profit, r.running_profit)
        for r in found.collect()
    ]
    assert sorted(actual) == sorted(expected)


def test_equal_rows_spread_over_slices(spark):
    same = spark.range(4000).select(F.lit(1).alias("k"))
    sliced = scale.spread_by_order(same, [F.col("k")], partitions=4)
    assert sliced.groupBy("slice").count().agg(F.max("count")).first()[0] < 2500
    ranks = scale.global_rank(same, [F.col("k")]).agg(F.min("rank"), F.max("rank"), F.countDistinct("rank"))
    assert tuple(ranks.first()) == (0, 3999, 4000)


@pytest.mark.parametrize("sizes", [(1, 2, 3), (1000, 1001, 64)])
def test_exact_medians(spark, sizes):
    draw = random.Random(3)
    rows = [
        (group, draw.choice([1.0, 2.0, draw.random() * 100, -5.5]))
        for group, size in enumerate(sizes)
        for _ in range(size)
    ]
    rows.append((0, None))
    found = quantiles.exact_medians(spark.createDataFrame(rows, "g int, v double"), ["g"], "v")
    expected = {g: statistics.median(v for k, v in rows if k == g and v is not None) for g in range(3)}
    assert {r.g: r["median"] for r in found.collect()} == pytest.approx(expected)


def test_containment_equals_comparing_all(spark):
    listed = market(
        spark,
        ("abc", "1", "2", "1", "0", "bitcoin"),
        ("bc", "3", "4", "1", "0", "trump"),
        ("bc", "5", "6", "1", "0", "trump again"),
        ("zzz", "7", "8", "1", "0", "movie"),
        ("", "9", "10", "1", "0", "win"),
    )
    rows = [
        trade("m", "t", "xABCx", "0", 1, 2),
        trade("m", "t", "0", "bcbc", 3, 4),
        trade("m", "t", None, "bc", 5, 6),
        trade("m", "t", "q", "r", 7, 8),
        trade("m", "t", "bc", "abc", 9, 10),
    ]
    found = {
        r.category: (r.trade_count, r.estimated_vol_usd)
        for r in categories.trade_activity_by_category(trades(spark, *rows), listed).collect()
    }
    expected = {}
    names = {"abc": "Crypto", "bc": "Politics", "zzz": "Pop Culture", "": "Sports"}
    for condition, copies in (("abc", 1), ("bc", 2), ("zzz", 1), ("", 1)):
        hits = [r for r in rows if any(a is not None and condition in a.lower() for a in r[5:7])]
        if hits:
            units = sum(r[7] + r[8] for r in hits) * copies
            expected[names[condition]] = (len(hits) * copies, round(units / 2e6, 2))
    assert found == expected


def test_category_comparison_of_equal_stages(spark):
    stats = spark.createDataFrame([("a", "Crypto"), ("b", "Sports")], "trader string, primary_category string")
    compared = categories.category_comparison(stats, categories.with_one_hot(stats))
    assert categories.total_difference(compared).first()[0] == 0


@pytest.fixture(scope="module")
def updated(sample):
    return scale.cut_lineage(registry._updated(sample))


def test_scaled_features(updated):
    scaled = features.scaled_features(updated)
    for name in features.NUMERIC_FEATURES:
        mean, deviation = scaled.agg(F.avg(name), F.stddev_pop(name)).first()
        assert mean == pytest.approx(0, abs=1e-9)
        assert deviation == pytest.approx(1) or deviation == 0


def test_kmeans_keeps_the_best_start(updated):
    vectors = features.feature_vectors(features.scaled_features(updated)).cache()
    costs = [clusters.fit_kmeans(vectors, k=3, starts=1, seed=s).cost for s in (42, 43, 44)]
    best = clusters.fit_kmeans(vectors, k=3, starts=3)
    assert best.cost == pytest.approx(min(costs)) and best.costs == pytest.approx(costs)
    labels = clusters.kmeans_clusters(vectors, k=3, starts=1)
    assert labels.select("kmeans_cluster").distinct().count() == 3
    assert labels.count() == vectors.count()


def test_projection_has_descending_variance(updated):
    projected = features.project(features.feature_vectors(features.scaled_features(updated)))
    first, second = projected.agg(F.var_pop("proj_1"), F.var_pop("proj_2")).first()
    assert first >= second > 0


def test_legend_of_one_cluster(updated):
    row = clusters.cluster_legend(updated.withColumn("cluster", F.lit(0))).first()
    assert row.rank_win == row.rank_odds == 1.0


def test_report_of_a_constant(spark):
    rows = spark.createDataFrame([(0, 0.0), (1, 0.0)], "cluster int, v double")
    assert {r.diff_pct for r in clusters.cluster_report(rows, features=["v"]).collect()} == {0.0}


def test_thinning_keeps_the_busiest(spark):
    names = "trader string, " + ", ".join(
        f"{n} {'long' if n.startswith('total_trade_number') else 'double'}" for n in schemas.STAT_COLUMNS
    )
    rows = [(f"t{i:05d}", *[float(i + 1) if not n.startswith("total_trade_number") else i + 1 for n in schemas.STAT_COLUMNS]) for i in range(1500)]
    stats = spark.createDataFrame(rows, names).withColumn("primary_category", F.lit("Crypto"))
    plotted = points.plot_rows(categories.with_one_hot(stats))
    kept = points.thin_points(plotted, 10, x_field="avg_odds", y_field="win_rate").collect()
    assert len(kept) == 1000
    assert sorted(r.trader for r in kept if r.part == "head") == [f"t{i:05d}" for i in range(800, 1500)]
    assert max(r.radius for r in kept) == pytest.approx(8.0)
    again = points.thin_points(plotted.repartition(7), 10, x_field="avg_odds", y_field="win_rate").collect()
    assert {r.trader for r in again} == {r.trader for r in kept}
    assert points.thin_points(plotted, category="Sports", x_field="avg_odds", y_field="win_rate").count() == 0
    assert points.thin_points(plotted, min_trades=1500, x_field="avg_odds", y_field="win_rate").count() == 1


def test_lookup_join_follows_a_grown_dimension(spark, tmp_path):
    facts = spark.range(1_000_000).withColumnRenamed("id", "k")
    path = str(tmp_path / "dimension")

    def plan(rows: int) -> str:
        spark.range(rows).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v")).write.mode("append").parquet(path)
        joined = scale.lookup_join(facts, spark.read.parquet(path), "k")
        return joined._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        assert "BroadcastHashJoin" in plan(50)
        assert "SortMergeJoin" in plan(20_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 20))


def test_sums_do_not_depend_on_partitions(spark):
    rows = spark.range(1_000_000).select(
        F.lit("a").alias("g"), (F.lit(50.0) + (F.col("id") * 7919 % 1000003) / 1000003.0).alias("price"), (F.col("id") * 104729 % 10**9).alias("units")
    )
    found = {
        tuple(rows.repartition(n).groupBy("g").agg(grid_mean(F.col("price")), exact_sum(F.col("units"))).first())
        for n in (1, 3, 7, 16)
    }
    grid = sum(round((50.0 + (i * 7919 % 1000003) / 1000003.0) * 1e9) for i in range(1_000_000))
    units = sum(i * 104729 % 10**9 for i in range(1_000_000))
    assert found == {("a", float(grid) / 1e9 / 1_000_000, units)}


def test_rounding_goes_away_from_zero(spark):
    units = [9_999, 10_000, 29_999, 30_000, 50_000, 2**60]
    found = spark.createDataFrame([(u,) for u in units], "u long").select(rounded_away(F.col("u"), 20_000).alias("r"))
    assert [r.r for r in found.collect()] == [float((u + 10_000) // 20_000) for u in units]


def test_stages_are_dropped(spark, tmp_path):
    kept = scale.cut_lineage(spark.range(3))
    assert kept.count() == 3
    assert scale.drop_stages(spark) > 0 and scale.drop_stages(spark) == 0


def test_defaults_sample_one_in_a_hundred(spark):
    names = [f"0x{i}" for i in range(600)]
    busy = [trade(n, None, "0", "1", 1, 1) for n in names for _ in range(100)] + [trade("0x9999999", None, "0", "1", 1, 1)]
    found = {r.trader for r in subset.sample_traders(trades(spark, *busy)).collect()}
    assert found == {n for n in names if int(hashlib.md5(n.encode()).hexdigest()[:8], 16) % 100 == 0}
    assert subset.trades_by_maker(trades(spark, *busy)).count() == 0
    assert subset.trades_by_maker(trades(spark, *busy), more_than=99).count() == 600
