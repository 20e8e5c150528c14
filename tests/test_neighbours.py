"""The neighbour layout: near rows found, places better than the projection's, bounded blocks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from fillscope import scale
from fillscope.operators import features, kmeans, neighbours


def vectors_of(spark, table):
    rows = [(f"t{i}", [float(x) for x in v]) for i, v in enumerate(table)]
    frame = spark.createDataFrame(rows, "trader string, values array<double>")
    return scale.cut_lineage(frame.select("trader", array_to_vector("values").alias("features")))


@pytest.fixture(scope="module")
def curled(spark):
    """A curled sheet, which no projection keeps flat."""
    draw = np.random.default_rng(2)
    turn, height = draw.uniform(4, 14, 900), draw.uniform(0, 10, 900)
    table = np.stack([turn * np.cos(turn), height, turn * np.sin(turn), draw.normal(size=900) * 0.1], 1)
    return table, vectors_of(spark, table)


def exact_trust(high, low, k=10):
    n = len(high)
    far = ((high[:, None] - high[None]) ** 2).sum(2)
    flat = ((low[:, None] - low[None]) ** 2).sum(2)
    for m in (far, flat):
        np.fill_diagonal(m, np.inf)
    ranks = far.argsort(1).argsort(1) + 1
    chosen = np.take_along_axis(ranks, flat.argsort(1)[:, :k], 1)
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(chosen - k, 0).sum()


def test_most_near_rows_are_found(spark, curled):
    table, vectors = curled
    nodes = neighbours.layout_nodes(vectors)
    assert neighbours.nearest_rows(nodes).count() == 900
    number = {r.node: int(r.trader[1:]) for r in nodes.collect()}
    grid = np.rint(table * kmeans.GRID) / kmeans.GRID
    far = ((grid[:, None] - grid[None]) ** 2).sum(2)
    np.fill_diagonal(far, np.inf)
    true = far.argsort(1)[:, :15]
    hits = 0
    for row in neighbours.nearest_rows(nodes).collect():
        found = [number[n.other] for n in row.near]
        assert len(set(found)) == 15 and number[row.node] not in found
        assert [n.distance for n in row.near] == sorted(n.distance for n in row.near)
        hits += len(set(found) & set(true[number[row.node]].tolist()))
    assert hits / (900 * 15) > 0.9


def test_places_keep_neighbourhoods(spark, curled):
    table, vectors = curled
    placed = scale.cut_lineage(neighbours.neighbour_layout(vectors, rounds=5))
    assert placed.count() == 900 and placed.select("trader").distinct().count() == 900
    projected = scale.cut_lineage(features.project(vectors))
    trust = neighbours.trustworthiness(vectors, placed, ("place_1", "place_2"), sample=900)
    assert trust > neighbours.trustworthiness(vectors, projected, ("proj_1", "proj_2"), sample=900)
    places = {r.trader: (r.place_1, r.place_2) for r in placed.collect()}
    assert trust == pytest.approx(exact_trust(table, np.array([places[f"t{i}"] for i in range(900)])), abs=1e-3)


def test_rounds_over_several_partitions(spark, curled, monkeypatch):
    table, vectors = curled
    monkeypatch.setattr(neighbours, "PART_ROWS", 200)
    placed = scale.cut_lineage(neighbours.neighbour_layout(vectors, rounds=4))
    assert placed.count() == 900
    assert neighbours.trustworthiness(vectors, placed, ("place_1", "place_2")) > 0.9


def test_equal_few_and_no_rows(spark):
    assert neighbours.neighbour_layout(vectors_of(spark, [[1.0, 2.0]]).limit(0), rounds=1).count() == 0
    one = neighbours.neighbour_layout(vectors_of(spark, [[1.0, 2.0], [3.0, 2.5]]), rounds=1, steps=3).collect()
    assert len(one) == 2 and all(np.isfinite([r.place_1, r.place_2]).all() for r in one)
    # Many equal rows share every leaf; blocks stay bounded all the same.
    same = neighbours.nearest_rows(neighbours.layout_nodes(vectors_of(spark, [[1.0, 2.0]] * 700)))
    assert same.count() == 700
