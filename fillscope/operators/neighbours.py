"""A two-dimensional layout in which near traders stay near, without one task that holds all of them.

1. Random-projection trees order the rows. The cuts of a tree come from a bounded sample; below its leaves rows go
   by one more projection. Rows are range-partitioned by that order and compared within blocks of
   consecutive rows, so a block is bounded however many rows share a leaf. The best of several trees are a
   row's neighbours.
2. Places start from the principal components. In a round, rows are range-partitioned by place; each
   partition moves its own rows for some steps, towards their neighbours and away from drawn rows, while rows of
   other partitions stay where the round found them.

Partitions hold a bounded number of rows each, and the driver sees samples of bounded size only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillscope.operators import features, kmeans
from fillscope.scale import cut_lineage

TREES, NEIGHBOURS, BLOCK_ROWS = 8, 15, 256
# Rows that fit the trees' cuts, and the sample's rows in a leaf.
TREE_SAMPLE, LEAF_SAMPLE = 4096, 32
ROUNDS, STEPS = 8, 25
# Rows of a partition in a round, and places sent to all of them as a sample of the rest.
PART_ROWS, FAR_ROWS = 16_384, 1024
DRAWN, PUSH, CLIP, SPREAD = 8, 5.0, 4.0, 10.0
# Rows that the spread has room for. More rows start on a plane that is wider by the root, as the forces act at a fixed
# distance: crowded places would be mixed by the pushes of their drawn rows.
SPREAD_ROWS = 512


class Trees:
    """Cuts of random-projection trees by tree and inner node (heap order), and one direction per tree."""

    def __init__(self, sample: np.ndarray, trees: int, seed: int):
        draw = np.random.default_rng(seed)
        width = sample.shape[1]
        self.depth = max(0, int(np.ceil(np.log2(max(1, len(sample)) / LEAF_SAMPLE))))
        inner = (1 << self.depth) - 1
        self.directions = draw.normal(size=(trees, inner, width))
        self.cuts = np.zeros((trees, inner))
        self.along = draw.normal(size=(trees, width))
        for t in range(trees):
            node = np.zeros(len(sample), np.int64)
            for level in range(self.depth):
                at = self.project(sample, self.directions[t][node])
                for n in range((1 << level) - 1, (2 << level) - 1):
                    if (node == n).any():
                        self.cuts[t, n] = np.median(at[node == n])
                node = 2 * node + 1 + (at > self.cuts[t][node])

    @staticmethod
    def project(rows: np.ndarray, directions: np.ndarray) -> np.ndarray:
        """Row by row products, added up one component after another: the same for any batch."""
        total = np.zeros(len(rows))
        for j in range(rows.shape[1]):
            total += rows[:, j] * (directions[..., j])
        return total

    def order(self, rows: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of each row, and its place inside the leaf."""
        node = np.zeros(len(rows), np.int64)
        for _ in range(self.depth):
            at = self.project(rows, self.directions[tree][node])
            node = 2 * node + 1 + (at > self.cuts[tree][node])
        return node, self.project(rows, self.along[tree])


def least(table: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k least numbers of each row, least first, the first among equals: a prefix of a stable sort."""
    if k >= table.shape[1]:
        return np.argsort(table, axis=1, kind="stable")
    best = np.sort(np.argpartition(table, k - 1, axis=1)[:, :k], axis=1)
    found = np.take_along_axis(table, best, 1)
    best = np.take_along_axis(best, np.argsort(found, axis=1, kind="stable"), 1)
    # Equals of the last one may have been left out before it.
    tied = np.count_nonzero(table <= found.max(1)[:, None], axis=1) > k
    best[tied] = np.argsort(table[tied], axis=1, kind="stable")[:, :k]
    return best


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def nearest_rows(nodes: DataFrame, trees: int = TREES, k: int = NEIGHBOURS, seed: int = 42) -> DataFrame:
    """Rows (node, near): up to k near rows of each, as (squared distance, node), nearest first.

    ``nodes`` has (node bigint, place array<bigint>), as stored by ``layout_nodes``.
    """
    shape = Trees(kmeans.seed_sample(nodes, "node", TREE_SAMPLE), trees, seed)

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = kmeans._matrix(batch.column("place")) / kmeans.GRID
            for t in range(trees if len(rows) else 0):
                leaf, along = shape.order(rows, t)
                columns = [pa.array(np.full(len(rows), t, np.int32)), pa.array(leaf), pa.array(along), *batch.columns]
                yield pa.record_batch(columns, ["tree", "leaf", "along", "node", "place"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(names: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
            far = kmeans.squared_distances(rows, rows)
            np.fill_diagonal(far, np.inf)
            best = least(far, min(k, len(names) - 1))
            sizes = np.full(len(names), best.shape[1])
            columns = [pa.array(names), _lists(sizes, pa.array(names[best].ravel())), _lists(sizes, pa.array(np.take_along_axis(far, best, 1).ravel()))]
            return pa.record_batch(columns, ["node", "others", "distances"])

        tree, names, rows = -1, np.zeros(0, np.int64), None
        for batch in batches:
            all_trees = batch.column("tree").to_numpy()
            all_names, all_rows = batch.column("node").to_numpy(), kmeans._matrix(batch.column("place")) / kmeans.GRID
            for t in np.unique(all_trees):
                mine = all_trees == t
                if t != tree:
                    if len(names) > 1:
                        yield edges(names, rows)
                    tree, names, rows = t, np.zeros(0, np.int64), all_rows[:0]
                names, rows = np.concatenate([names, all_names[mine]]), np.concatenate([rows, all_rows[mine]])
                while len(names) >= BLOCK_ROWS:
                    yield edges(names[:BLOCK_ROWS], rows[:BLOCK_ROWS])
                    names, rows = names[BLOCK_ROWS:], rows[BLOCK_ROWS:]
        if len(names) > 1:
            yield edges(names, rows)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of a node's lists, of which there is one per tree; the same pair is equally far in all of them."""
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).sort_by("node").combine_chunks()
        sizes = table.column("others").combine_chunks().value_lengths().to_numpy()
        names, first, lists = np.unique(table.column("node").to_numpy(), return_index=True, return_counts=True)
        row = np.repeat(np.arange(len(names)), lists)
        place = np.arange(len(row)) - first[row]
        filled = np.arange(k)[None, :] < sizes[:, None]
        at = (np.repeat(row, sizes), (place[:, None] * k + np.arange(k)[None, :])[filled])
        far, other = np.full((len(names), lists.max() * k), np.inf), np.full((len(names), lists.max() * k), -1)
        far[at], other[at] = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("distances", "others"))
        ranked = np.lexsort((other, far), axis=1)
        far, other = np.take_along_axis(far, ranked, 1), np.take_along_axis(other, ranked, 1)
        fresh = other >= 0
        fresh[:, 1:] &= other[:, 1:] != other[:, :-1]
        kept = fresh & (np.cumsum(fresh, axis=1) <= k)
        pairs = pa.StructArray.from_arrays([pa.array(far[kept]), pa.array(other[kept])], ["distance", "other"])
        yield pa.record_batch([pa.array(names), _lists(kept.sum(1), pairs)], ["node", "near"])

    order = ["tree", "leaf", "along", "node"]
    keyed = nodes.select("node", "place").mapInArrow(ordered, "tree int, leaf bigint, along double, node bigint, place array<bigint>")
    size = nodes.count()
    dealt = keyed.repartitionByRange(max(1, -(-size * trees // PART_ROWS)), *order).sortWithinPartitions(*order)
    found = dealt.mapInArrow(compared, "node bigint, others array<bigint>, distances array<double>")
    # A node has one list per tree, and a partition the lists of a bounded number of nodes.
    met = found.repartition(max(1, -(-size // PART_ROWS)), "node")
    return met.mapInArrow(merged, "node bigint, near array<struct<distance:double,other:bigint>>")


def layout_nodes(vectors: DataFrame, key: str = "trader") -> DataFrame:
    """Rows (key, node, place), stored, so that the numbers of the nodes stay."""
    rows = kmeans.grid_rows(vectors, key)
    return cut_lineage(rows.withColumn("node", F.monotonically_increasing_id()))


def moved(places: np.ndarray, others: np.ndarray, near: np.ndarray, known: np.ndarray, far: np.ndarray, steps: range, total: int, draw) -> np.ndarray:
    """Move a partition's rows for some steps.

    ``near`` holds a row's neighbours as numbers of ``places`` followed by ``others``; ``known`` marks the real ones. Attraction
    acts on both ends that lie here; repulsion comes from drawn rows of this partition and of ``far``.
    """
    count = len(places)
    # One array per axis, one row per neighbour: sums over neighbours then run along memory.
    spots = [np.concatenate([places[:, axis], others[:, axis]]) for axis in (0, 1)]
    near, known = np.ascontiguousarray(near.T), np.ascontiguousarray(known.T)
    weight = np.maximum(known.sum(0), 1).astype(float)
    home = np.flatnonzero(known & (near < count))
    ends = near.ravel()[home]
    real = known.astype(float)
    for step in steps:
        rate = 1 - step / total
        gaps = [spot[None, :count] - spot[near] for spot in spots]
        scale = -2 / (1 + (gaps[0] * gaps[0] + gaps[1] * gaps[1])) * real
        drawn = draw.integers(count + len(far), size=(count, DRAWN)).T
        away = [spot[None, :count] - np.concatenate([spot[:count], far[:, axis]])[drawn] for axis, spot in enumerate(spots)]
        square = away[0] * away[0] + away[1] * away[1]
        repel = 2 / ((0.01 + square) * (1 + square))
        for spot, gap, apart in zip(spots, gaps, away):
            pull = np.clip(np.multiply(scale, gap, out=gap), -CLIP, CLIP, out=gap)
            pull /= weight
            force = pull.sum(0) - np.bincount(ends, weights=pull.ravel()[home], minlength=count)
            push = np.clip(np.multiply(repel, apart, out=apart), -CLIP, CLIP, out=apart)
            spot[:count] += rate * np.clip(force + PUSH * push.mean(0), -CLIP, CLIP)
    return np.stack([spot[:count] for spot in spots], 1)


def neighbour_layout(vectors: DataFrame, key: str = "trader", rounds: int = ROUNDS, steps: int = STEPS, seed: int = 42) -> DataFrame:
    """Rows (key, place_1, place_2). No rows for none."""
    nodes = layout_nodes(vectors, key)
    size = nodes.count()
    if not size:
        return nodes.select(key, F.lit(0.0).alias("place_1"), F.lit(0.0).alias("place_2"))
    near = cut_lineage(nearest_rows(nodes, seed=seed))
    start = features.project(vectors.select(F.col(key).alias("trader"), "features"))
    first = nodes.select("node", F.col(key).alias("trader")).join(start, "trader").select("node", "proj_1", "proj_2")
    reach = first.agg(F.greatest(F.max(F.abs("proj_1")), F.max(F.abs("proj_2"))).alias("reach")).first().reach or 1.0
    room = SPREAD * max(1.0, (size / SPREAD_ROWS) ** 0.5)
    where = cut_lineage(first.select("node", (F.col("proj_1") * room / reach).alias("x"), (F.col("proj_2") * room / reach).alias("y")))
    parts = max(1, -(-size // PART_ROWS))
    for turn in range(rounds):
        sample = where.orderBy(F.xxhash64("node", F.lit(turn)), "node").limit(FAR_ROWS).select("x", "y").toPandas().to_numpy()
        spots = where.select(F.col("node").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
        # A node has at most NEIGHBOURS neighbours, with their places of this round.
        others = F.collect_list(F.struct("other", "ox", "oy"))
        around = near.select("node", F.explode("near.other").alias("other")).join(spots, "other").groupBy("node").agg(others.alias("others"))
        placed = where.join(around, "node", "left")
        dealt = placed.repartitionByRange(parts, *(("x", "y") if turn % 2 == 0 else ("y", "x")), "node")

        def run(batches: Iterator[pa.RecordBatch], turn: int = turn, sample: np.ndarray = sample) -> Iterator[pa.RecordBatch]:
            held = list(batches)
            if not sum(batch.num_rows for batch in held):
                return
            table = pa.Table.from_batches(held).sort_by("node")
            names = table.column("node").to_numpy()
            places = np.stack([table.column(c).to_numpy() for c in ("x", "y")], 1)
            lists = table.column("others").combine_chunks()
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            flat = lists.flatten()
            found = [flat.field(i).to_numpy() for i in range(3)]
            # Neighbours here are the rows themselves, others keep the place they came with.
            here = np.searchsorted(names, found[0])
            inside = names[np.minimum(here, len(names) - 1)] == found[0]
            outer, at = np.unique(found[0][~inside], return_index=True)
            elsewhere = np.stack([found[1][~inside][at], found[2][~inside][at]], 1)
            number = np.where(inside, here, len(names) + np.searchsorted(outer, found[0]))
            known = np.arange(NEIGHBOURS)[None, :] < sizes[:, None]
            neighbours = np.zeros((len(names), NEIGHBOURS), np.int64)
            neighbours[known] = number
            draw = np.random.default_rng([seed, turn, int(names[0])])
            own = moved(places, elsewhere, neighbours, known, sample, range(turn * steps, (turn + 1) * steps), rounds * steps, draw)
            yield pa.record_batch([pa.array(names), pa.array(own[:, 0]), pa.array(own[:, 1])], ["node", "x", "y"])

        where = cut_lineage(dealt.select("node", "x", "y", "others").mapInArrow(run, "node bigint, x double, y double"))
    return nodes.select(key, "node").join(where, "node").select(key, F.col("x").alias("place_1"), F.col("y").alias("place_2"))


def trustworthiness(vectors: DataFrame, places: DataFrame, axes: tuple[str, str], key: str = "trader", k: int = 10, sample: int = 512) -> float:
    """How far near places are near vectors: 1 if no false neighbour, over a sample of rows against all rows.

    Two passes: the k nearest places of each sampled row, then the ranks of these among all vectors. The sample, the
    first rows in hash order, is broadcast.
    """
    rows = kmeans.grid_rows(vectors, key).join(places.select(key, F.array(*axes).alias("at")), key)
    rows = cut_lineage(rows.select(F.xxhash64(F.col(key).cast("string")).alias("name"), "place", "at"))
    size = rows.count()
    asked = rows.orderBy("name").limit(sample).toArrow()
    if size <= 2 * k:
        return 1.0
    names = asked.column("name").to_numpy()
    high = kmeans._matrix(asked.column("place").combine_chunks()) / kmeans.GRID
    low = kmeans._matrix(asked.column("at").combine_chunks())

    def themselves(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a batch holds the sampled rows."""
        columns = np.flatnonzero(np.isin(own, names))
        q, at = np.nonzero(names[:, None] == own[columns][None, :])
        return q, columns[at]

    def distances(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Squared distances of pairs, as ``squared_distances`` adds them up."""
        total = np.zeros(len(q))
        for j in range(high.shape[1]):
            gap = high[q, j] - rows[:, j]
            total += gap * gap
        return total

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("name").to_numpy()
            flat = kmeans.squared_distances(low, kmeans._matrix(batch.column("at")))
            flat[themselves(own)] = np.inf
            best = least(flat, k)
            q = np.repeat(np.arange(len(names)), best.shape[1])
            far = distances(q, kmeans._matrix(batch.column("place"))[best.ravel()] / kmeans.GRID)
            columns = [q, own[best].ravel(), np.take_along_axis(flat, best, 1).ravel(), far]
            yield pa.record_batch(list(map(pa.array, columns)), ["q", "name", "flat", "far"])

    found = rows.mapInArrow(nearest, "q bigint, name bigint, flat double, far double")
    best = F.slice(F.sort_array(F.collect_list(F.struct("flat", "name", "far"))), 1, k)
    chosen = found.where("flat < double('infinity')").groupBy("q").agg(best.alias("best")).orderBy("q").collect()
    limits = np.array([[b.far for b in r.best] for r in chosen])

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows nearer than each limit. A matrix product decides, except where rounding could matter."""
        total = np.zeros(limits.shape, np.int64)
        squares = (high**2).sum(1)
        for batch in batches:
            rows = kmeans._matrix(batch.column("place")) / kmeans.GRID
            if not len(rows):
                continue
            theirs = (rows**2).sum(1)
            about = squares[:, None] + theirs[None, :] - 2 * (high @ rows.T)
            about[themselves(batch.column("name").to_numpy())] = np.inf
            slack = 1e-9 * (squares + theirs.max() + 1)
            for i in range(limits.shape[1]):
                below = np.count_nonzero(about < (limits[:, i] - slack)[:, None], axis=1)
                open_ = np.flatnonzero(np.count_nonzero(about <= (limits[:, i] + slack)[:, None], axis=1) > below)
                at, r = np.nonzero(np.abs(about[open_] - limits[open_, i, None]) <= slack[open_, None])
                q = open_[at]
                total[:, i] += below + np.bincount(q[distances(q, rows[r]) < limits[q, i]], minlength=len(names))
        slots = np.arange(total.size)
        yield pa.record_batch([pa.array(slots), pa.array(total.ravel())], ["slot", "below"])

    counted = rows.mapInArrow(ranks, "slot bigint, below bigint").groupBy("slot").agg(F.sum("below").alias("below"))
    above = sum(max(0, r.below + 1 - k) for r in counted.collect())
    return 1 - 2 * above / (len(names) * k * (2 * size - 3 * k - 1))
