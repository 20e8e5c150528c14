"""Exact top-k search by inner product with pivot-table elimination.

Distances of all vectors to a set of pivots are computed once. The triangle inequality
turns them into a lower bound of the distance between a query and a candidate, the
largest over all pivots, and with both norms into an upper bound of their inner
product. A query evaluates candidates in the order of their bounds and stops when the next
bound is below its k-th score.

Queries meet all candidates in blocks: a cell holds one block of each, of bounded size, and keeps
the k best of each query.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillscope.scale import cut_lineage

K, SCALE = 20, 64
# Rows of a block of queries and of candidates: the size of a cell, whatever the table.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 8192
PIVOTS = 32
# Candidates evaluated at once in the order of their bounds.
STEP, LATER_STEP = 256, 2048
# Queries of a cell whose bounds are held at once.
QUERIES_AT_ONCE = 32
# Sums of whole numbers below these are exact in doubles and in single precision.
EXACT_SUM, EXACT_SINGLE_SUM = float(1 << 53), float(1 << 24)
LARGEST_DOUBLE = sys.float_info.max
NO_ID = (1 << 63) - 1


def integer_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows (row, id, vec): a number of the row, and components floor(scale * x) as doubles, which are whole.

    Rows without vector, and vectors with a null or non-finite component, are left out. Repeated rows and rows
    without an id are rows like others. Products beyond the range of doubles become its ends. The
    rows are stored, so that their numbers stay.
    """
    whole = F.transform(vectors[vector], lambda x: x.cast("double"))
    fine = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def step(x):
        product = x * F.lit(float(scale))
        # From 2^52 on a double is whole.
        return F.when(F.abs(product) < float(1 << 52), F.floor(product).cast("double")).otherwise(
            F.greatest(F.lit(-LARGEST_DOUBLE), F.least(F.lit(LARGEST_DOUBLE), product))
        )

    rows = vectors.select(vectors[key].cast("long").alias("id"), whole.alias("raw")).where(F.col("raw").isNotNull()).where(fine)
    return cut_lineage(rows.select(F.monotonically_increasing_id().alias("row"), "id", F.transform("raw", step).alias("vec")))


def pivot_vectors(vectors: DataFrame, count: int = PIVOTS) -> np.ndarray:
    """Pivots: the ``count`` vectors first in hash order, a bounded number of rows.

    Which vectors are pivots changes the work only, never a result.
    """
    rows = vectors.select("vec").distinct().orderBy(F.xxhash64("vec"), "vec").limit(count).collect()
    return padded([r["vec"] for r in rows])


def padded(vectors, width: int = 0) -> np.ndarray:
    """Vectors as rows of a matrix; short ones end in zeros."""
    width = max([width, *map(len, vectors)], default=width)
    if all(len(v) == width for v in vectors):
        return np.array([np.asarray(v, np.float64) for v in vectors]).reshape(len(vectors), width)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances by vector and pivot."""
    squares = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def search_cell(
    own: np.ndarray, queries: np.ndarray, names: np.ndarray, ids: np.ndarray, rows: np.ndarray, pivots: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """The k best rows of one cell for each query: (place of the query, place of the row, score).

    ``own`` and ``names`` are the row numbers of queries and candidates: a query does not find itself.
    Equal scores go in the order of ``ids``.
    """
    width = max(queries.shape[1], rows.shape[1], pivots.shape[1])
    queries, rows, pivots = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (queries, rows, pivots))
    if np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * width >= EXACT_SUM:
        return [(q, i, s) for q, query in enumerate(queries) for i, s in large_scores(query, rows, ids, names != own[q], k)]
    if np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * width < EXACT_SINGLE_SUM:
        scored_rows, scored_queries = rows.astype(np.float32), queries.astype(np.float32)
    else:
        scored_rows, scored_queries = rows, queries
    # Bounds in single precision; a little slack for rounding, so that no bound is below its score.
    to_pivots = np.ascontiguousarray(distances(rows, pivots).T, np.float32)
    from_queries = distances(queries, pivots).astype(np.float32)
    norms, query_norms = (rows**2).sum(1).astype(np.float32), (queries**2).sum(1).astype(np.float32)
    found = []
    for start in range(0, len(queries), QUERIES_AT_ONCE):
        some = slice(start, start + QUERIES_AT_ONCE)
        nearest = np.zeros((len(queries[some]), len(rows)), np.float32)
        gap = np.empty_like(nearest)
        for p in range(len(pivots)):
            np.subtract(to_pivots[p][None, :], from_queries[some, p][:, None], out=gap)
            np.maximum(nearest, np.abs(gap, out=gap), out=nearest)
        sizes = query_norms[some][:, None] + norms[None, :]
        all_bounds = (sizes - nearest**2) / 2 + 1e-5 * (1 + sizes)
        for q, bounds in enumerate(all_bounds, start):
            bounds[names == own[q]] = -np.inf
            found += [(q, i, s) for i, s in best_of(scored_queries[q], scored_rows, ids, bounds, k)]
    return found


def best_of(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, bounds: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (place, score) of one query: candidates in the order of their bounds, until the next bound is
    below the k-th score. Later steps are longer, and sort only candidates that may still matter."""
    scores, best = np.zeros(0), np.zeros(0, np.int64)
    limit, size, done = -np.inf, STEP, None
    order = np.argpartition(-bounds, STEP)[:STEP] if len(bounds) > STEP else np.arange(len(bounds))
    order = order[np.argsort(-bounds[order])]
    at = 0
    while True:
        if at >= len(order):
            if done is not None or len(bounds) <= STEP:
                break
            # What the first step left: everything whose bound reaches the k-th score.
            done = np.zeros(len(bounds), bool)
            done[order] = True
            order = np.flatnonzero(~done & (bounds >= limit))
            order, at, size = order[np.argsort(-bounds[order])], 0, LATER_STEP
            continue
        part = order[at : at + size]
        at += size
        part = part[bounds[part] > -np.inf]
        if not len(part) or bounds[part[0]] < limit:
            break
        fresh = rows[part] @ query
        may = fresh >= limit
        scores, best = np.concatenate([scores, fresh[may]]), np.concatenate([best, part[may]])
        top = np.lexsort((ids[best], -scores))[:k]
        scores, best = scores[top], best[top]
        if len(best) == k:
            limit = scores[-1]
    return [(int(i), int(s)) for i, s in zip(best, scores)]


def large_scores(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (place, score) where doubles cannot hold the sums: whole numbers decide among the near best.

    Vectors are scaled down first, and a bound on the rounding error tells which rows may be among the best. Scores
    beyond the range of a long are its ends.
    """
    places = np.flatnonzero(allowed)
    high, low = max(np.abs(rows).max(initial=0), 1), max(np.abs(query).max(initial=0), 1)
    scaled, small = rows[places] / high, query / low
    rough, error = scaled @ small, 1e-14 * len(query) * (np.abs(scaled) @ np.abs(small)) + 1e-300
    if len(places) > k:
        limit = np.partition(rough - error, -k)[-k]
        places = places[rough + error >= limit]
    whole = [int(x) for x in query]
    ends = (1 << 63) - 1
    scores = [max(-ends - 1, min(ends, sum(int(x) * y for x, y in zip(rows[i], whole)))) for i in places]
    order = sorted(range(len(places)), key=lambda j: (-scores[j], ids[places[j]]))[:k]
    return [(int(places[j]), scores[j]) for j in order]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, pivots: int = PIVOTS) -> DataFrame:
    """The k best candidates of each query: query_id, rank (from 1), vec_id, score.

    Both tables have columns (row, id, vec), as ``integer_vectors`` makes them. Score: inner product; a shorter
    vector counts as ending in zeros; ties go to the smaller id, none comes last. Candidates are all rows
    but the query's own row. Queries with fewer candidates get them all. Each query row has its own list, also where rows
    share an id.
    """
    table = pivot_vectors(vectors, pivots)
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(table)
    blocks = lambda df, size: max(1, -(-df.count() // size))
    n_rows, n_queries = blocks(vectors, CANDIDATE_BLOCK), blocks(queries, QUERY_BLOCK)
    # pandas has no whole numbers with gaps: a missing id is the largest, and marked.
    plain = [F.col("row"), F.coalesce("id", F.lit(NO_ID)).alias("id"), F.col("id").isNotNull().alias("known"), F.col("vec")]
    # Every block of queries meets every block of candidates once.
    rows = vectors.select(*plain, F.pmod(F.xxhash64("row"), F.lit(n_rows)).alias("row_block"))
    rows = rows.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    asked = queries.select(*plain, F.pmod(F.xxhash64("row"), F.lit(n_queries)).alias("query_block"))
    asked = asked.withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_row", "query_id", "query_known", "id", "known", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame([], columns=columns)
        found = search_cell(
            left["row"].to_numpy(np.int64),
            padded(left["vec"]),
            right["row"].to_numpy(np.int64),
            right["id"].to_numpy(np.int64),
            padded(right["vec"]),
            shared.value,
            k,
        )
        q, i, scores = (np.array([f[c] for f in found], np.int64) for c in range(3))
        values = (left["row"], left["id"], left["known"]), (right["id"], right["known"])
        return pd.DataFrame(dict(zip(columns, [*[v.to_numpy()[q] for v in values[0]], *[v.to_numpy()[i] for v in values[1]], scores])))

    keys = [F.col("query_block").cast("long"), F.col("row_block").cast("long")]
    schema = "query_row bigint, query_id bigint, query_known boolean, id bigint, known boolean, score bigint"
    best = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(cell, schema)
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(
        F.when(F.col("query_known"), F.col("query_id")).alias("query_id"), "rank", F.when(F.col("known"), F.col("id")).alias("vec_id"), "score"
    )
