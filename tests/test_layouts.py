"""Stored layouts, incremental loads, rejects and rows by position."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillscope import scale, schemas
from fillscope.operators import positions, subset
from fillscope.sources import layouts, sinks
from fillscope.streaming import incremental


def rows(df):
    return sorted(map(repr, df.collect()))


def leaves(df):
    """The scans of an executed query, with their metrics."""
    df.collect()

    def below(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return below(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return below(plan.plan())
        found = plan.collectLeaves()
        under = [found.apply(i) for i in range(found.size())]
        return [x for leaf in under for x in (below(leaf) if leaf.getClass().getSimpleName().endswith("QueryStageExec") else [leaf])]

    return [leaf for leaf in below(df._jdf.queryExecution().executedPlan()) if "FileScan" in leaf.toString() or "FileSourceScan" in leaf.getClass().getSimpleName()]


def metric(scan, name):
    return scan.metrics().apply(name).value()


@pytest.fixture(scope="module")
def small(spark):
    """Fills of which half trade one token, by one busy maker in two spellings."""
    fields = [f.name for f in schemas.TRADES]
    data = []
    for i in range(4000):
        token = "1000002" if i % 2 else str(1000000 + i % 50)
        maker = ["0xBusy", "0xbusy"][i % 4 // 2] if i % 3 else f"0xM{i % 40}"
        taker = None if i % 17 == 0 else "0xBUSY" if i % 97 == 0 else f"0xT{i % 60}"
        data.append((f"h{i}", i % 7, i // 10, maker, taker, "0" if i % 5 else token, token if i % 5 else "0", 10 + i, 20 + i))
    trades = scale.cut_lineage(spark.createDataFrame(data, schemas.TRADES).select(fields))
    times = [(b, f"2024-01-{1 + b // 20 % 28:02d}T{b % 24:02d}:00:00Z" if b % 31 else "no time") for b in range(390)]
    blocks = scale.cut_lineage(spark.createDataFrame(times, schemas.BLOCKS))
    prices = {0: '["1","0"]', 1: '["0","1"]', 2: '["0.5","0.5"]'}
    listed = [(f"q{k}", f'["{1000000 + 2 * k}","{1000001 + 2 * k}"]', prices[k % 3], 1.0, "0xmm", str(1000000 + 2 * k)) for k in range(20)]
    markets = scale.cut_lineage(spark.createDataFrame(listed, schemas.MARKETS))
    return trades, blocks, markets


def test_bucketed_fills_are_not_exchanged(spark, small, monkeypatch):
    trades, blocks, markets = small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        names = layouts.store_bucketed(trades, blocks, markets, "small", buckets=4, salts=8)
        found = layouts.bucketed_positions(spark, *names)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(found) == rows(positions.positions(trades, blocks, markets))
        # The hot token, half of all fills, fills no single bucket.
        sizes = [r.n for r in spark.table(names[0]).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 4000 and max(sizes) < 2000
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(key, str(64 * 1024 * 1024))
        for name in ("small_fills", "small_tokens"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_address_index_reads_few_rows(spark, small, tmp_path, monkeypatch):
    trades, _, _ = small
    monkeypatch.setattr(layouts, "INDEX_GROUP_BYTES", 8 << 10)
    path = str(tmp_path / "index")
    layouts.store_address_index(trades, path, files=8)
    for address in ("0xm3", "0XT7", "0xbusy"):
        found = layouts.indexed_trades(spark, path, address)
        expected = trades.where((F.lower("maker") == address.lower()) | (F.lower("taker") == address.lower()))
        assert rows(found.select(trades.columns)) == rows(expected)
    stored = spark.read.parquet(path).count()
    scan = leaves(layouts.indexed_trades(spark, path, "0xm3"))[0]
    assert 0 < metric(scan, "numOutputRows") < stored / 4
    assert layouts.indexed_trades(spark, path, "0xabsent").count() == 0
    assert layouts.indexed_trades(spark, path, None).count() == 0
    assert layouts.indexed_address(spark, path, "0xBUSY").first().maker in ("0xBusy", "0xbusy")
    assert layouts.indexed_address(spark, path, "0xT7").first() is None
    both = spark.read.parquet(path).where("role = 'both'")
    assert both.where("lower(maker) <> lower(taker)").count() == 0
    assert layouts.indexed_trades(spark, path, "0xbusy").groupBy("transaction_hash", "log_index").count().where("count > 1").count() == 0


def test_days_are_pruned_when_the_query_runs(spark, small, tmp_path):
    trades, blocks, _ = small
    path = str(tmp_path / "days")
    layouts.store_by_day(trades, blocks, path)
    day = blocks.where(F.col("timestamp").startswith("2024-01-05"))
    found = layouts.trades_of_blocks(spark, path, day)
    scan = next(s for s in leaves(found) if "dynamicpruning" in s.toString())
    assert rows(layouts.trades_of_blocks(spark, path, day)) == rows(trades.join(day.withColumnRenamed("timestamp", "block_time"), "block_number").select(found.columns))
    whole = spark.read.parquet(path)
    assert 0 < metric(scan, "numOutputRows") == whole.where("day = '2024-01-05'").count() < whole.count() / 10
    # Trades of blocks without a time are kept under their own day.
    assert whole.where(F.col("day") == layouts.UNKNOWN_DAY).count() == trades.join(
        blocks.where("timestamp <> 'no time'"), "block_number", "left_anti"
    ).count()


SCHEMA = "maker string, taker string"


def make_files(spark, folder, names, n=10):
    for name in names:
        frame = spark.createDataFrame([(f"{name}{i % 3}", None if i == 5 else "t") for i in range(n)], SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(folder)


def test_load_is_exactly_once(spark, tmp_path):
    folder, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    assert incremental.loaded_trades(spark, target, SCHEMA).count() == 0 and incremental.loaded_counts(spark, target).count() == 0
    make_files(spark, folder, ["a", "b"])

    def agree():
        whole = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(folder)
        assert rows(incremental.loaded_trades(spark, target, SCHEMA)) == rows(whole)
        assert rows(incremental.loaded_counts(spark, target)) == rows(subset.trader_counts(whole))

    incremental.load_files(stream(spark, folder), target, checkpoint)
    agree()
    incremental.load_files(stream(spark, folder), target, checkpoint)
    agree()
    make_files(spark, folder, ["c"])
    incremental.load_files(stream(spark, folder), target, checkpoint)
    agree()
    # Started over with a new checkpoint: every file is known.
    incremental.load_files(stream(spark, folder), target, str(tmp_path / "other"))
    agree()
    make_files(spark, folder, ["d"])
    incremental.load_files(stream(spark, folder), target, str(tmp_path / "third"))
    agree()


def test_replayed_and_broken_batches(spark, tmp_path):
    target = str(tmp_path / "out")
    first = spark.createDataFrame([("m", "t", "f1"), ("m", None, "f1"), ("n", "t", "f2")], f"{SCHEMA}, _source_file string")
    same = lambda batch: batch
    incremental.load_batch(first, "q-0", target, same)
    before = rows(incremental.loaded_trades(spark, target, SCHEMA)), rows(incremental.loaded_counts(spark, target))
    incremental.load_batch(first, "q-0", target, same)
    assert (rows(incremental.loaded_trades(spark, target, SCHEMA)), rows(incremental.loaded_counts(spark, target))) == before

    # A batch that stops before its commit is not seen, and its replay is seen once.
    second = spark.createDataFrame([("x", "y", "f3"), ("m", "t", "f2")], f"{SCHEMA}, _source_file string")
    sinks.write_parquet(second.drop("_source_file"), f"{target}/rows/load=q-1")
    assert rows(incremental.loaded_trades(spark, target, SCHEMA)) == before[0]
    incremental.load_batch(second, "q-1", target, same)
    # f2 came with the first batch already.
    assert incremental.loaded_trades(spark, target, SCHEMA).count() == 4
    assert {r.trader: r.total_trades for r in incremental.loaded_counts(spark, target).collect()} == {"m": 2, "n": 1, "t": 2, "x": 1, "y": 1}


def test_kept_and_rejected_sides_are_all_sides(spark, small, tmp_path):
    trades, blocks, markets = small
    sides = positions.judged_sides(trades, blocks, markets)
    judged = positions.split_rejects(sides, str(tmp_path / "rejects"))
    assert sum(judged.counts.values()) == 2 * trades.count()
    assert judged.counts[None] == positions.positions(trades, blocks, markets).count()
    assert judged.rejects.count() == sum(n for reason, n in judged.counts.items() if reason)
    assert all(judged.counts[reason] > 0 for reason in judged.counts)
    none = positions.split_rejects(sides.limit(0))
    assert none.rejects.count() == 0 and set(none.counts.values()) == {0}


@pytest.mark.parametrize("position", [0, 1234, 4999])
def test_row_at(spark, position):
    df = spark.range(5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("v"), F.lit("x").alias("_slice0"))
    assert scale.row_at(df, position, ["v"], sorted_rows=50).first().v == position
    assert scale.row_at(df, 5000, ["v"], sorted_rows=50).count() == 0


def test_row_at_among_equal_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2900, 1).otherwise(F.col("id")).alias("v"))
    assert scale.row_at(df, 2899, ["v"], sorted_rows=100).first().v == 1
    assert scale.row_at(df, 2900, ["v"], sorted_rows=100).first().v == 2900
    assert scale.row_at(df.limit(0), 0, ["v"]).count() == 0
    with pytest.raises(ValueError, match="negative"):
        scale.row_at(df, -1, ["v"])
    plan = scale.row_at(df, 5, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan


def test_types_survive_the_index(spark, small, tmp_path):
    trades, _, _ = small
    layouts.store_address_index(trades, str(tmp_path / "i"), files=2)
    kept = spark.read.parquet(str(tmp_path / "i"))
    assert T.StructType([kept.schema[f.name] for f in schemas.TRADES]) == schemas.TRADES


def test_stages_end_with_their_scope(spark):
    outer = scale.cut_lineage(spark.range(3))
    with scale.stages(spark):
        inner = scale.cut_lineage(outer.where("id > 0"))
        assert inner.count() == 2
        path = scale._stages[-1]
    assert outer.count() == 3 and path not in scale._stages
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError), scale.stages(spark):
        scale.cut_lineage(spark.range(1))
        raise ValueError
    assert outer.count() == 3
