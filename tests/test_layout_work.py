"""The work of the neighbour layout: lists instead of pairs, and results that the shortcuts leave as they were."""

from __future__ import annotations

import numpy as np
import pytest
from test_neighbours import exact_trust, vectors_of

from fillscope import scale
from fillscope.operators import neighbours


def test_a_node_sends_one_list_per_tree(spark):
    """Pairs met in an aggregate before, 15 rows per node and tree."""
    draw = np.random.default_rng(1)
    nodes = neighbours.layout_nodes(vectors_of(spark, draw.normal(size=(300, 3))))
    near = neighbours.nearest_rows(nodes, trees=3, k=4)
    assert "Aggregate" not in near._jdf.queryExecution().optimizedPlan().toString()
    rows = near.collect()
    assert len(rows) == 300
    for row in rows:
        assert len(row.near) == 4 and len({n.other for n in row.near}) == 4
        assert [tuple(n) for n in row.near] == sorted(tuple(n) for n in row.near)


def test_one_block_gives_the_exact_neighbours(spark):
    """Rows of which many are equally far, all in one block of every tree."""
    table = np.random.default_rng(3).integers(0, 3, size=(200, 3)).astype(float)
    nodes = neighbours.layout_nodes(vectors_of(spark, table))
    number = {r.node: int(r.trader[1:]) for r in nodes.collect()}
    far = ((table[:, None] - table[None]) ** 2).sum(2)
    np.fill_diagonal(far, np.inf)
    for row in neighbours.nearest_rows(nodes).collect():
        assert [n.distance for n in row.near] == sorted(far[number[row.node]])[:15]


@pytest.mark.parametrize("k", [1, 7, 39, 40, 60])
def test_least_is_a_stable_sort(k):
    table = np.random.default_rng(k).integers(0, 9, size=(50, 40)).astype(float)
    table[::3, ::4] = np.inf
    assert (neighbours.least(table, k) == np.argsort(table, axis=1, kind="stable")[:, :k]).all()


def test_trustworthiness_counts_ties_exactly(spark):
    """Vectors on a coarse lattice: most distances are equal to others, where a matrix product alone would not do."""
    draw = np.random.default_rng(4)
    table, low = draw.integers(0, 4, size=(400, 5)) + draw.normal(size=(400, 5)).round(1), draw.normal(size=(400, 2))
    places = spark.createDataFrame([(f"t{i}", float(x), float(y)) for i, (x, y) in enumerate(low)], "trader string, x double, y double")
    with scale.stages(spark):
        found = neighbours.trustworthiness(vectors_of(spark, table), places, ("x", "y"), sample=400)
    grid = np.rint(table * neighbours.kmeans.GRID) / neighbours.kmeans.GRID
    far = neighbours.kmeans.squared_distances(grid, grid)
    np.fill_diagonal(far, np.inf)
    flat = ((low[:, None] - low[None]) ** 2).sum(2)
    np.fill_diagonal(flat, np.inf)
    best = flat.argsort(1)[:, :10]
    below = np.stack([(row[None, :] < row[b][:, None]).sum(1) for row, b in zip(far, best)])
    above = np.maximum(0, below + 1 - 10).sum()
    assert found == pytest.approx(1 - 2 * above / (400 * 10 * (800 - 31)), abs=1e-12)
    assert found == pytest.approx(exact_trust(table, low), abs=0.02)


@pytest.mark.parametrize("rows, reach", [(300, 10.0), (2048, 20.0)])
def test_more_rows_start_on_a_wider_plane(spark, rows, reach):
    """On a plane of one size for all, trustworthiness fell from 0.93 to 0.74 with 480 thousand traders."""
    vectors = vectors_of(spark, np.random.default_rng(6).normal(size=(rows, 3)))
    with scale.stages(spark):
        start = neighbours.neighbour_layout(vectors, rounds=1, steps=0).collect()
    assert max(max(abs(r.place_1), abs(r.place_2)) for r in start) == pytest.approx(reach)
