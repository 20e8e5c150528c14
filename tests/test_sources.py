"""Loaders, sinks, catalogue and profile."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fillscope import schemas
from fillscope.operators import clusters
from fillscope.plans import registry
from fillscope.sources import catalog, footers, readers, sinks
from test_rules import trade, trades

WIDE = "21742633143463906290569050155826241533067272736897614950488156847949938836455"


def test_wide_ids_survive_csv(spark, tmp_path):
    rows = trades(spark, trade("a", None, "0", WIDE, 1, 2))
    sinks.write_csv(rows, str(tmp_path / "csv"))
    back = readers.read_csv(spark, str(tmp_path / "csv"), schemas.TRADES)
    assert back.schema == schemas.TRADES
    assert back.first() == rows.first()


def test_stray_files_are_skipped(spark, tmp_path):
    rows = trades(spark, trade("a", "b", "0", WIDE, 1, 2))
    path = tmp_path / "trades"
    sinks.write_parquet(rows, str(path))
    sinks.append_parquet(rows, str(path))
    (path / "._part-0.parquet").write_bytes(b"not parquet")
    assert readers.read_trades(spark, str(path)).count() == 2


def test_required_columns(spark):
    with pytest.raises(ValueError, match="log_index, taker"):
        schemas.require_columns(spark.range(1).toDF("maker"), ("maker", "taker", "log_index"))


def test_stats_with_and_without_category(spark, sample, tmp_path):
    stats = registry._stats(sample)
    sinks.write_csv(stats, str(tmp_path / "plain"))
    plain = readers.read_trader_stats(spark, str(tmp_path / "plain"))
    assert plain.schema == schemas.TRADER_STATS
    updated = registry._updated(sample)
    sinks.write_csv(updated, str(tmp_path / "updated"))
    back = readers.read_trader_stats(spark, str(tmp_path / "updated"))
    assert back.columns[0] == "primary_category"
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, updated.collect()))


def test_catalogue(spark, sample, tmp_path):
    files = str(tmp_path / "trades")
    sinks.write_parquet(sample.trades, files)
    names = catalog.register_warehouse(spark, sample.markets, files, "wh")
    # Another session finds the objects: they are no temporary views.
    other = spark.newSession()
    found = {r.object_name: r for r in catalog.describe_objects(other, [*names, "absent"]).collect()}
    assert found["wh_trades"].row_count == 6000 and found["wh_trades"].object_type == "VIEW"
    assert files in found["wh_trades"].definition and "maker string" in found["wh_trades"].columns
    assert found["wh_markets"].object_type == "TABLE" and "USING parquet" in found["wh_markets"].definition
    assert found["absent"].object_type is None and found["absent"].n_columns == 0
    assert "maker" in catalog.table_columns(spark, "wh_trades")
    # The view copies nothing: it shows what its files hold now. A second registration replaces both.
    sinks.append_parquet(sample.trades.limit(10), files)
    assert spark.table("wh_trades").count() == 6010
    catalog.register_warehouse(spark, sample.markets.limit(3), files, "wh")
    assert spark.table("wh_markets").count() == 3
    sample.markets.createOrReplaceTempView("wh_temporary")
    assert catalog.definition(spark, "wh_temporary")["object_type"] == "VIEW"
    for name in names:
        catalog.drop_object(spark, name)
    assert not spark.catalog.tableExists("wh_markets") and not spark.catalog.tableExists("wh_trades")


def _jobs(spark, build):
    """Rows of a query, and the number of Spark jobs it took."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    rows = build().collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return rows, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_profile_of_many_files_takes_as_many_jobs_as_of_few(spark, tmp_path):
    for folder, files in (("few", 5), ("many", 1500)):
        (tmp_path / folder).mkdir()
        for i in range(files):
            kind = pa.int64() if i % 2 else pa.list_(pa.float32())
            value = i if i % 2 else [0.5]
            pq.write_table(pa.table({"id": pa.array([i], pa.int32()), "v": pa.array([value], kind)}), tmp_path / folder / f"x{i}.parquet")
    rows, jobs = _jobs(spark, lambda: catalog.profile_dataset(spark, str(tmp_path / "few")))
    more_rows, more_jobs = _jobs(spark, lambda: catalog.profile_dataset(spark, str(tmp_path / "many")))
    assert len(rows) == 5 and len(more_rows) == 1500 and 0 < more_jobs == jobs
    assert {r.schema for r in more_rows} == {"id int, v bigint", "id int, v array<float>"}


def test_footers_and_first_rows(spark, tmp_path):
    table = pa.table(
        {
            "a": pa.array([5, None, -7, 3], pa.int64()),
            "t": ["x", "ä", None, "b"],
            "none": pa.array([None] * 4, pa.int32()),
            "s": pa.array([{"k": 1}] * 4, pa.struct([("k", pa.int16())])),
            "d": pa.array([None, 1, 2, 3], pa.decimal128(9, 2)),
        }
    )
    pq.write_table(table, tmp_path / "x.parquet", row_group_size=2)
    pq.write_table(table.slice(0, 0), tmp_path / "y.parquet")
    found = {r.file_name: r for r in catalog.profile_dataset(spark, str(tmp_path)).collect()}
    assert (found["x.parquet"].row_groups, found["x.parquet"].total_rows) == (2, 4)
    assert found["x.parquet"].schema == "a bigint, t string, none int, s struct<k:smallint>, d decimal(9,2)"
    assert found["y.parquet"].total_rows == 0 and found["x.parquet"].below_root == "."
    columns = catalog.profile_columns(spark, str(tmp_path)).collect()
    ranges = {(r.file_name, r.column_name): (r.n_nulls, r.min_value, r.max_value) for r in columns}
    assert ranges["x.parquet", "a"] == (1, "-7", "5") and ranges["x.parquet", "t"] == (1, "b", "ä")
    assert ranges["x.parquet", "none"] == (4, None, None) and ranges["y.parquet", "a"] == (None, None, None)
    rows = sorted((r.position, r.row_json) for r in catalog.preview_files(spark, str(tmp_path), 3).collect())
    assert [p for p, _ in rows] == [0, 1, 2] and '"t": "ä"' in rows[1][1]


def test_files_that_only_spark_opens(spark, tmp_path, monkeypatch):
    spark.range(10, numPartitions=2).write.parquet(str(tmp_path / "in"))
    expected = sorted(map(tuple, catalog.profile_dataset(spark, str(tmp_path / "in")).collect()))
    monkeypatch.setattr(footers, "DIRECT_SCHEMES", ())
    assert "content" in footers.data_files(spark, str(tmp_path / "in")).columns
    assert sorted(map(tuple, catalog.profile_dataset(spark, str(tmp_path / "in")).collect())) == expected


def test_profile_skips_and_limits(spark, tmp_path):
    for folder, files in (("trades", 5), ("blocks", 1)):
        spark.range(10, numPartitions=files).write.parquet(str(tmp_path / folder))
    found = catalog.profile_dataset(spark, str(tmp_path), max_files=3).collect()
    assert len(found) == 3
    assert {(r.total_rows, r.n_columns, r.schema) for r in found} == {(2, 1, "id bigint")}
    some = catalog.list_data_files(spark, str(tmp_path)).first().path
    assert catalog.preview(spark, some).count() == 2
    assert catalog.nth_row(spark.range(100), 42, ["id"]).first().id == 42


def test_profile_keeps_folders_and_empty_files_apart(spark, tmp_path):
    assert catalog.profile_dataset(spark, str(tmp_path)).count() == 0
    for folder, rows in (("a", 3), ("b", 5), ("c", 0)):
        (tmp_path / folder).mkdir()
        pq.write_table(pa.table({"id": pa.array(range(rows), pa.int64())}), tmp_path / folder / "x.parquet")
    found = catalog.profile_dataset(spark, str(tmp_path)).collect()
    assert sorted((r.folder.rsplit("/", 1)[1], r.file_name, r.total_rows) for r in found) == [
        ("a", "x.parquet", 3),
        ("b", "x.parquet", 5),
        ("c", "x.parquet", 0),
    ]


def test_saved_table_is_replaced(spark):
    sinks.save_table(spark.range(3), "saved_rows")
    sinks.save_table(spark.range(5), "saved_rows")
    found = catalog.describe_objects(spark, ["saved_rows"]).first()
    assert (found.object_type, found.row_count) == ("TABLE", 5)
    spark.sql("DROP TABLE saved_rows")


def test_report_text(spark, tmp_path):
    rows = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 5.0)], "cluster int, v double")
    report = clusters.cluster_report(rows, features=["v"])
    sinks.write_report(report, str(tmp_path / "report"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert "cluster 0 | v: mean=2.0000, median=2.0000, global=3.0000, diff=-1.0000, -33.3%" in lines
