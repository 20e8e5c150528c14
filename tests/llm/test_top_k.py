"""Exact top-k search against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fillscope.llm import topk


def plain(rows, queries, k):
    """(query id, rank, id, score) by all pairs of rows (number, id, vector); 20 best, ties to the smaller id."""
    found, ends = [], 2**63 - 1
    for n, q, v in queries:
        scored = []
        for m, i, w in rows:
            if m != n:
                score = sum(int(a) * int(b) for a, b in zip(v, w))
                scored.append((-max(-ends - 1, min(ends, score)), i is None, i or 0))
        found += [(q, at + 1, None if none else i, -s) for at, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(found, key=repr)


def searched(whole, k=20):
    return sorted(map(tuple, topk.top_k(whole, whole.where("id % 20 = 0"), k).collect()), key=repr)


def expected(whole, k=20):
    rows = [(r.row, r.id, r.vec) for r in whole.collect()]
    return plain(rows, [r for r in rows if r[1] is not None and r[1] % 20 == 0], k)


@pytest.mark.parametrize("blocks", [(1024, 8192), (7, 50)])
def test_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(300, 8))
    vectors[100:160] = vectors[0]
    vectors[160:170] = 0
    table = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    # Repeated rows, another vector under a used id, a short vector, and rows without an id.
    table += [table[3], table[20], (20, table[7][1]), (400, [1.5, -2.0]), (None, table[20][1]), (None, table[5][1])]
    bad = [(500, None), (501, [1.0, None]), (502, [float("nan")] * 8), (503, [float("inf")] * 8)]
    frame = spark.createDataFrame(table + bad, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).withColumn("row", F.lit(1))
    whole = topk.integer_vectors(frame)
    rows = sorted(((r.id, tuple(r.vec)) for r in whole.collect()), key=repr)
    assert rows == sorted(((i, tuple(float(np.floor(64 * float(np.float32(x)))) for x in v)) for i, v in table), key=repr)
    found = searched(whole)
    assert found == expected(whole)
    assert len([r for r in found if r[0] == 20]) == 60


def test_large_components(spark):
    draw = np.random.default_rng(9)
    table = [(i, [float(x) for x in draw.normal(size=6)]) for i in range(80)]
    table += [(100, [1e17] * 6), (101, [-1e17] * 6), (102, [1e17, -1e17, 3.0, 0.0, 0.0, 0.0]), (120, [1e8] * 6), (121, [1e8 + 1] * 6), (122, [1e300] * 6), (140, [-1.7e308] * 6)]
    whole = topk.integer_vectors(spark.createDataFrame(table, "vec_id long, embedding array<double>"))
    assert searched(whole, 20) == expected(whole, 20)


def test_few_and_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (20, [2.0]), (3, [-1.0])], "vec_id long, embedding array<float>")
    whole = topk.integer_vectors(frame)
    found = sorted(map(tuple, topk.top_k(whole, whole.where("id % 20 = 0")).collect()))
    assert found == [(0, 1, 20, 8192), (0, 2, 3, -4096), (20, 1, 0, 8192), (20, 2, 3, -8192)]
    none = topk.integer_vectors(frame.limit(0))
    assert topk.top_k(none, none).count() == 0
    assert topk.top_k(whole, none).count() == 0


def test_bounds_stop_early_and_keep_ties():
    rows = np.array([[100.0, 0.0]] * 3 + [[1.0, 0.0]] * 5000)
    ids = np.arange(len(rows))[::-1].copy()
    pivots = np.array([[0.0, 0.0], [100.0, 0.0]])
    found = topk.search_cell(np.array([-1]), np.array([[10.0, 0.0]]), ids, ids, rows, pivots, 4)
    assert [(q, int(ids[i]), s) for q, i, s in found] == [(0, 5000, 1000), (0, 5001, 1000), (0, 5002, 1000), (0, 0, 10)]


def test_near_scores_beyond_doubles_are_told_apart():
    rows = np.array([[float(2**60), 1.0], [float(2**60), 2.0], [float(2**60), 0.0]])
    found = topk.large_scores(np.array([4.0, 1.0]), rows, np.arange(3), np.ones(3, bool), 2)
    assert found == [(1, 2**62 + 2), (0, 2**62 + 1)]
