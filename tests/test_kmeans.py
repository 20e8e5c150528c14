"""Multi-start k-means: the same under any partitioning, right on small inputs, no rows at the driver."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from fillscope import scale
from fillscope.operators import clusters, kmeans


def vectors_of(spark, table):
    rows = [(f"t{i}", [float(x) for x in v]) for i, v in enumerate(table)]
    frame = spark.createDataFrame(rows, "trader string, values array<double>")
    return frame.select("trader", array_to_vector("values").alias("features"))


@pytest.fixture(scope="module")
def blobs(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(scale=8, size=(4, 5))
    table = np.concatenate([c + draw.normal(size=(250, 5)) for c in centres])
    return table, scale.cut_lineage(vectors_of(spark, table))


def test_labels_do_not_depend_on_partitions(blobs):
    _, vectors = blobs
    fits = []
    for n in (1, 3, 7):
        rows = scale.cut_lineage(kmeans.grid_rows(vectors).repartition(n))
        fitted = kmeans.fit(rows, 4, 5, 42, clusters.TOLERANCE)
        fits.append((fitted, sorted(map(tuple, kmeans.assign(rows, fitted).collect()))))
    assert fits[0] == fits[1] == fits[2]
    assert fits[0][0].settled and len(fits[0][0].costs) == 5


def test_finds_separate_groups(blobs):
    table, vectors = blobs
    labels = {r.trader: r.kmeans_cluster for r in clusters.kmeans_clusters(vectors, k=4).collect()}
    groups = [{labels[f"t{i}"] for i in range(g * 250, (g + 1) * 250)} for g in range(4)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 4
    cost = sum(((table[g * 250 : (g + 1) * 250] - table[g * 250 : (g + 1) * 250].mean(0)) ** 2).sum() for g in range(4))
    assert clusters.fit_kmeans(vectors, k=4).cost == pytest.approx(cost, rel=1e-3)
    row = clusters.check_clusters(vectors, k=4).first()
    assert (row.labelled, row.clusters, row.not_nearest, row.off_mean, row.cheaper_starts) == (1000, 4, 0, 0, 0)


def test_check_sees_wrong_fits(blobs, monkeypatch):
    _, vectors = blobs
    honest = kmeans.fit

    def shifted(*args, **kwargs):
        fitted = honest(*args, **kwargs)
        centres = [[x + 1 for x in c] for c in fitted.centres]
        return kmeans.Clustering(centres, fitted.cost, fitted.start, fitted.costs, fitted.rounds, fitted.settled)

    monkeypatch.setattr(kmeans, "fit", shifted)
    row = clusters.check_clusters(vectors, k=4).first()
    assert row.off_mean == 4 and row.cheaper_starts > 0
    monkeypatch.setattr(kmeans, "assign", lambda rows, fitted: rows.select("trader", F.lit(0).alias("kmeans_cluster")))
    assert clusters.check_clusters(vectors, k=4).first().not_nearest > 0


def test_few_equal_and_no_rows(spark):
    assert kmeans.fit(kmeans.stored_rows(vectors_of(spark, [[1.0, 2.0]]).limit(0)), 3, 2, 1, 0.01) is None
    assert clusters.kmeans_clusters(vectors_of(spark, [[1.0, 2.0]]).limit(0)).count() == 0
    same = vectors_of(spark, [[1.0, 2.0]] * 20)
    assert {r.kmeans_cluster for r in clusters.kmeans_clusters(same, k=3, starts=2).collect()} == {0}
    two = vectors_of(spark, [[0.0], [10.0]])
    assert clusters.fit_kmeans(two, k=2, starts=3).cost == 0


def test_ties_are_measured_one_by_one():
    rows = np.array([[0.0, 0.0], [1.0, 0.0], [0.5, 3.0]])
    centres = np.array([[[1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]])
    assert kmeans.nearest_centres(rows, centres)[:, 0].tolist() == [1, 0, 0]


def test_a_pass_returns_one_row_per_start_and_cluster(blobs):
    table, vectors = blobs
    rows = scale.cut_lineage(kmeans.grid_rows(vectors).repartition(5))
    centres = np.stack([table[:3], table[300:303]])
    sums = kmeans._pass(rows, centres)
    assert sums.shape == (2, 3, 7) and (sums[:, :, 0].sum(1) == 1000).all()
    grid = np.rint(table * kmeans.GRID).astype(np.int64)
    assert (sums[:, :, 2:].sum(1) == grid.sum(0)).all()
