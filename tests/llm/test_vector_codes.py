"""Vector codes against a plain version with Python's integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fillscope.llm import vector_codes
from fillscope.llm.queries import vector_code_rows

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long, vector string, summed_label int"


def whole(x: float) -> int:
    return math.floor(256 * x) if abs(x) < 2**50 else 256 * int(x)


def plain(rows, entries=64, rounds=2):
    """The codes by checking every entry: 16 parts, 64 entries, 2 rounds, 256 steps to one."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(1, -(-max((len(r[1]) for r in kept), default=0) // 16))
    ints = [[whole(x) for x in r[1]] + [0] * (16 * width - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(ints[i], p) for i in order[:entries]] for p in range(16)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(16):
            groups = {}
            for v in ints:
                groups.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            for n, group in groups.items():
                books[p][n] = [sum(c) // len(group) for c in zip(*group)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded, sums = [], {}
    for r, v in zip(kept, ints):
        found = [nearest(cut(v, p), books[p]) for p in range(16)]
        error = sum(d for d, _ in found)
        sums[r[2]] = sums.get(r[2], 0) + error
        coded.append((r[0], "".join(f"{n:02x}" for _, n in found), error, r[2]))
    most = 2**63 - 1
    return sorted([(i, c, min(e, most), min(sums[label], most), sha) for i, c, e, label in coded], key=repr)


def found(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(parts)
    result = vector_code_rows(frame).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted(map(tuple, result.collect()), key=repr)


def draw_rows(n, width=32, seed=3):
    draw = np.random.default_rng(seed)
    return [(i * 3 % (n + 1), [float(x) for x in draw.normal(size=width)], [None, 1, 2][i % 3]) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_equals_brute_force(spark, parts):
    rows = draw_rows(150)
    rows += [(7, rows[3][1], 1), (7, rows[3][1], 1), (None, [0.25] * 32, 2), (None, [0.0] * 32, None)]
    rows += [(900 + i, [0.5] * 32, 4) for i in range(60)]
    bad = [(1, None, 1), (2, [1.0, None], 2), (3, [float("nan")] * 32, 1), (4, [float("-inf")] + [1.0] * 31, 1)]
    assert found(spark, rows + bad, parts) == plain(rows + bad)


def test_lengths_few_rows_and_none(spark):
    rows = [(1, [1.0] * 20, 1), (2, [], 1), (3, [0.5], None), (4, [-3.0] * 33, 2)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, [(1, None, 1)]) == []
    assert found(spark, [(5, [0.1] * 16, None)]) == plain([(5, [0.1] * 16, None)])


def test_large_components(spark):
    rows = draw_rows(80, 16)
    rows += [(200, [1e17] * 16, 1), (201, [-1e300] * 16, 2), (202, [1.7e308, *[0.0] * 15], 2), (203, [3e5] * 16, 3)]
    assert found(spark, rows) == plain(rows)


def test_expansion_equals_full_search():
    draw = np.random.default_rng(5)
    entries = draw.integers(-4, 5, size=(64, 4)).tolist()
    parts = draw.integers(-5, 6, size=(500, 4))
    name, distance = vector_codes.SortedBook(entries, True).nearest(parts)
    for v, n, d in zip(parts.tolist(), name, distance):
        assert (d, n) == min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(entries))


def test_decode_gives_the_entries(spark):
    frame = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in draw_rows(40, 16)], SCHEMA)
    kept = vector_codes.kept_vectors(frame)
    books = vector_codes.fit(kept, entries=64, rounds=0)
    for row in vector_codes.encode(kept, books).join(kept.select("vec_id", "vector"), "vec_id").where(F.col("error") == 0).collect():
        assert max(abs(a - b) for a, b in zip(books.decode(row.code), row.vector)) <= 0.5 / 256 + 1e-9
