"""Every registered query against its SQL, and every plan against the forbidden joins."""

from __future__ import annotations

import pytest
from compare import open_tables, spark_rows, sql_rows

from __spark_entry__ import entry, oracle_sql, queries

SQL = oracle_sql()


@pytest.fixture(scope="module")
def tables(folder):
    return open_tables(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, folder, tables):
    result = queries()[name](spark, folder)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns, rows = spark_rows(result)
    sql_columns, expected = sql_rows(tables, SQL[name])
    assert columns == sql_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    found = entry(spark)
    assert found.columns == ["user_address", "trade_count", "wins", "win_rate"]
    assert found.count() > 0


def test_leaderboard_scans_the_trades_once(spark, folder):
    plan = queries()["win_rate_leaderboard"](spark, folder)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("l_partkey") and text.count("FileScan parquet [l_") == 1
    assert "TakeOrderedAndProject" in text
