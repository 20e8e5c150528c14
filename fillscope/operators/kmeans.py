"""k-means with many starts, all of which move on in the same pass over the rows.

A pass assigns every row to the nearest centre of every start that still moves, and sums the rows per
start and cluster inside the tasks. Spark adds up these partial sums; the driver sees one row per start and
cluster, whatever the number of rows, and moves the centres.

Rows lie on an integer grid and distances are summed component by component, so that neither sums nor
labels depend on how the rows are dealt or batched. Starts are drawn, by squared distances, from a sample of at
most ``SEED_ROWS`` rows, the first in hash order, and move there first, so that few passes over all rows
remain; the fit itself reads all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillscope.scale import cut_lineage

# Steps of the grid per unit, and of the grid of squared distances.
GRID = 1 << 20
SEED_ROWS = 1 << 15
SEED_THREADS = 8
MAX_ROUNDS = 300
# Rows of a batch that meet all centres at once.
SLICE_ROWS = 2048
# Steps towards the means of the clusters are longer by this factor, which saves passes.
STRIDE = 1.7


@dataclass(frozen=True)
class Clustering:
    """The fit of least cost, and how all starts ended."""

    centres: list[list[float]]
    cost: float
    start: int
    costs: list[float]
    rounds: int
    settled: bool


def grid_rows(vectors: DataFrame, key: str = "trader", features: str = "features") -> DataFrame:
    """Rows (key, place): the feature vector in whole steps of the grid."""
    steps = F.transform(vector_to_array(features), lambda x: F.rint(x * float(GRID)).cast("bigint"))
    return vectors.select(F.col(key), steps.alias("place"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def squared_distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances by row and centre; one component after another, the same for any batch."""
    total, gap = np.zeros((len(rows), len(centres))), np.empty((len(rows), len(centres)))
    for j in range(rows.shape[1]):
        np.subtract(rows[:, j, None], centres[None, :, j], out=gap)
        total += np.multiply(gap, gap, out=gap)
    return total


def nearest_centres(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each start by row, the lower number among equals; centres by start and number.

    A matrix product decides where the two best are clearly apart. The others, whose order could
    depend on rounding and so on the batch, are measured component by component.
    """
    starts, k, width = centres.shape
    flat = centres.reshape(starts * k, width)
    squares = (flat**2).sum(1)
    score = (squares - 2 * (rows @ flat.T)).reshape(len(rows), starts, k)
    label = score.argmin(2)
    if k > 1:
        two = np.partition(score, 1, axis=2)
        reach = (rows**2).sum(1)[:, None] + squares.max() + 1
        for row, start in zip(*np.nonzero(two[:, :, 1] - two[:, :, 0] <= 1e-9 * reach)):
            label[row, start] = squared_distances(rows[row : row + 1], centres[start])[0].argmin()
    return label


def seed_sample(rows: DataFrame, key: str, size: int = SEED_ROWS) -> np.ndarray:
    """A bounded sample: the first rows in hash order."""
    order = [F.xxhash64(F.col(key).cast("string")), F.col(key).cast("string"), F.col("place")]
    found = rows.orderBy(*order).limit(size).select("place").toArrow().column("place").combine_chunks()
    return _matrix(found) / GRID


def draw_centres(sample: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """k rows of the sample, each drawn by its squared distance from those before."""
    chosen = [int(draw.integers(len(sample)))]
    nearest = squared_distances(sample, sample[chosen])[:, 0]
    while len(chosen) < k:
        reach = np.cumsum(nearest)
        if reach[-1] > 0:
            place = min(int(np.searchsorted(reach, draw.random() * reach[-1], "right")), len(sample) - 1)
        else:
            place = int(draw.integers(len(sample)))
        chosen.append(place)
        nearest = np.minimum(nearest, squared_distances(sample, sample[[place]])[:, 0])
    return sample[chosen]


def settle_centres(sample: np.ndarray, centres: np.ndarray, tolerance: float, max_rounds: int = MAX_ROUNDS) -> np.ndarray:
    """Move the centres of one start on the sample alone, so that few passes over all rows remain."""
    k = len(centres)
    for _ in range(max_rounds):
        label = ((centres**2).sum(1) - 2 * sample @ centres.T).argmin(1)
        member = label[None, :] == np.arange(k)[:, None]
        counts = member.sum(1)[:, None]
        moved = np.where(counts > 0, (member @ sample) / np.maximum(counts, 1), centres)
        shift = ((moved - centres) ** 2).sum()
        centres = moved
        if shift <= tolerance**2:
            break
    return centres


def _pass(rows: DataFrame, centres: np.ndarray) -> np.ndarray:
    """One pass for all given starts: by start and cluster the count, the cost in grid steps, and the sums."""
    starts, k, width = centres.shape
    flat_centres = centres.reshape(starts * k, width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((starts * k, 2 + width), np.int64)
        for batch in batches:
            whole = _matrix(batch.column(0))
            for at in range(0, len(whole), SLICE_ROWS):
                steps = whole[at : at + SLICE_ROWS]
                places = steps / GRID
                slot = nearest_centres(places, centres) + np.arange(starts) * k
                distance = np.zeros(slot.shape)
                for j in range(width):
                    gap = places[:, j, None] - flat_centres[slot, j]
                    distance += gap * gap
                member = np.zeros((len(steps), starts * k))
                member[np.arange(len(steps))[:, None], slot] = 1
                # Sums of integers below 2^53: exact in doubles, in any order.
                total[:, 0] += member.sum(0).astype(np.int64)
                cost = np.rint(distance * GRID)
                total[:, 1] += np.bincount(slot.ravel(), weights=cost.ravel(), minlength=starts * k).astype(np.int64)
                total[:, 2:] += (member.T @ steps.astype(np.float64)).astype(np.int64)
        flat = total.ravel()
        slots = np.flatnonzero(flat)
        yield pa.record_batch([pa.array(slots, pa.int64()), pa.array(flat[slots], pa.int64())], ["slot", "amount"])

    partial = rows.select("place").mapInArrow(sums, "slot bigint, amount bigint")
    found = partial.groupBy("slot").agg(F.sum("amount").alias("amount")).toArrow()
    total = np.zeros(starts * k * (2 + width), np.int64)
    total[found.column("slot").to_numpy()] = found.column("amount").to_numpy()
    return total.reshape(starts, k, 2 + width)


def _means(centres: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Means of the clusters; a cluster without rows keeps its centre."""
    counts = sums[:, :, :1]
    means = sums[:, :, 2:] / np.maximum(counts, 1) / GRID
    return np.where(counts > 0, means, centres)


def fit(
    rows: DataFrame, k: int, starts: int, seed: int, tolerance: float, key: str = "trader", max_rounds: int = MAX_ROUNDS
) -> Clustering | None:
    """Fit on stored grid rows; None without rows.

    A start rests once the squared distances of its centres from the means of their rows add up to ``tolerance``^2
    at most. The cheapest start wins, the first among equals.
    """
    sample = seed_sample(rows, key)
    if not len(sample):
        return None

    def begin(s: int) -> np.ndarray:
        return settle_centres(sample, draw_centres(sample, k, np.random.default_rng(seed + s)), tolerance)

    with ThreadPoolExecutor(SEED_THREADS) as pool:
        centres = np.stack(list(pool.map(begin, range(starts))))
    moving, rounds = np.arange(starts), 0
    stride, costs = np.full(starts, STRIDE), np.full(starts, np.inf)
    while len(moving) and rounds < max_rounds:
        sums = _pass(rows, centres[moving])
        rounds += 1
        cost = sums[:, :, 1].sum(1) / GRID
        # A start that a long step made worse takes plain steps from now on.
        stride[moving] = np.where(cost > costs[moving], 1.0, stride[moving])
        costs[moving] = cost
        step = _means(centres[moving], sums) - centres[moving]
        rests = (step**2).sum((1, 2)) <= tolerance**2
        centres[moving] += np.where(rests, 1.0, stride[moving])[:, None, None] * step
        moving = moving[~rests]
    # Costs are those before the last small movement: one more pass gives the final ones.
    costs = _pass(rows, centres)[:, :, 1].sum(1) / GRID
    best = int(costs.argmin())
    return Clustering(centres[best].tolist(), float(costs[best]), best, costs.tolist(), rounds, not len(moving))


def assign(rows: DataFrame, clustering: Clustering | None, key: str = "trader", name: str = "kmeans_cluster") -> DataFrame:
    """Rows (key, cluster): the nearest centre, the lower number among equals."""
    if clustering is None:
        return rows.select(key, F.lit(None).cast("int").alias(name))
    centres = np.array([clustering.centres])

    @F.arrow_udf("int")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            whole = _matrix(column)
            parts = [nearest_centres(whole[at : at + SLICE_ROWS] / GRID, centres)[:, 0] for at in range(0, len(whole), SLICE_ROWS)]
            yield pa.array(np.concatenate(parts) if parts else [], pa.int32())

    return rows.select(key, label("place").alias(name))


def stored_rows(vectors: DataFrame, key: str = "trader") -> DataFrame:
    """Grid rows, stored: a fit reads them once per pass."""
    return cut_lineage(grid_rows(vectors, key))
