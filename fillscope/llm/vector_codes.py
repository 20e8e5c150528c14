"""Compression of vectors to short codes: one codebook per part, searched by equal averages.

A vector is cut into equal parts, and each part is replaced by the number of its nearest codebook
entry. Entries are kept in the order of their component sums. A part starts at its own sum and
walks outward in both directions; by the inequality of Cauchy and Schwarz an entry is at least
(sum gap)^2 / dimension away, so a direction ends once that bound strictly exceeds the best distance.
Entries at exactly the best distance are still met, since ties go to the lower number.

A round reads the vectors once. Tasks add up their parts per entry; Spark sums these partial sums, of which
there are as many as the codebooks have numbers, and only the sums come to the driver. All numbers are
integers, so that results do not depend on the partitioning. Components of any finite size are exact:
beyond the 64-bit range tasks compute with Python's integers, and sums travel in digits of 20 bits.

Defined results: rows whose vector is null or holds null or non-finite components are dropped; a null
id comes after all others; rows that repeat an id are rows like others, in the order of their vectors. Vectors
whose length is no multiple of the parts, or less than the longest, count as ending in zeros. With fewer rows
than entries the codebooks are shorter. An empty table has empty codebooks and no rows. An error beyond
the range of a long is the largest long. Names of other columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scale import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Sums travel in digits of so many bits: 2^43 rows fit a long.
DIGIT_BITS = 20
LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """Integer entries by part, entry and component; ``plain`` tells whether 64 bits hold every square."""

    entries: list[list[list[int]]]
    width: int
    scale: int
    digits: int
    plain: bool

    @property
    def parts(self) -> int:
        return len(self.entries)

    @property
    def sha256(self) -> str:
        """Digest of all numbers by part, entry and component, in decimals joined by commas."""
        numbers = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def sorted_books(self) -> list[SortedBook]:
        return [SortedBook(part, self.plain) for part in self.entries]

    def decode(self, code: str) -> list[float]:
        """The vector that a code stands for; components are the middles of their grid cells."""
        numbers = [int(code[i : i + 2], 16) for i in range(0, len(code), 2)]
        return [(x + 0.5) / self.scale for part, n in zip(self.entries, numbers) for x in part[n]]


class SortedBook:
    """One part's codebook in the order of component sums."""

    def __init__(self, entries: list[list[int]], plain: bool):
        kind = np.int64 if plain else object
        table = np.array(entries, kind).reshape(len(entries), -1)
        sums = table.sum(1) if len(entries) else np.zeros(0, kind)
        order = np.array(sorted(range(len(entries)), key=lambda i: (sums[i], i)), np.int64)
        self.names, self.table, self.sums = order, table[order], sums[order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each part's nearest entry; ties to the lower number."""
        own = parts.sum(1)
        width, size = parts.shape[1], len(self.names)
        place = np.searchsorted(self.sums, own)
        start = np.minimum(place, size - 1)
        best = ((parts - self.table[start]) ** 2).sum(1)
        name = self.names[start]
        for step, first in ((1, place), (-1, place - 1)):
            rows, at = np.arange(len(parts)), first
            while True:
                inside = (at >= 0) & (at < size)
                rows, at = rows[inside], at[inside]
                near = ((own[rows] - self.sums[at]) ** 2 <= width * best[rows]).astype(bool)
                rows, at = rows[near], at[near]
                if not len(rows):
                    break
                distance = ((parts[rows] - self.table[at]) ** 2).sum(1)
                better = ((distance < best[rows]) | ((distance == best[rows]) & (self.names[at] < name[rows]))).astype(bool)
                best[rows[better]] = distance[better]
                name[rows[better]] = self.names[at[better]]
                at = at + step
        return name, best


def kept_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Rows (vec_id, vector, label) whose vector has finite components only; the vector as doubles."""
    raw = F.transform(vectors[vector], lambda x: x.cast("double"))
    rows = vectors.select(vectors[key].cast("long").alias("vec_id"), raw.alias("vector"), vectors[label].alias("label"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vector").isNotNull()).where(fine)


def _whole(x: float, scale: int) -> int:
    """floor(scale * x), exactly, for doubles of any size."""
    return math.floor(scale * x) if abs(x) < 1 << 52 else scale * int(x)


def part_integers(column: pa.Array, parts: int, width: int, scale: int, plain: bool) -> np.ndarray:
    """Vectors of a batch as integers by row, part and component."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == parts * width).all():
        table = flat.reshape(len(lengths), parts * width)
    else:
        table = np.zeros((len(lengths), parts * width))
        rows = np.repeat(np.arange(len(lengths)), lengths)
        places = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        table[rows, places] = flat
    if plain:
        whole = np.floor(table * scale).astype(np.int64)
    else:
        whole = np.array([_whole(x, scale) for x in table.ravel().tolist()], object)
    return whole.reshape(len(lengths), parts, width)


def initial_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> Codebooks:
    """Codebooks of the first ``entries`` vectors by id, a bounded number of rows."""
    size = F.size("vector")
    widest = kept.agg(
        F.max(size).alias("n"), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x)))).alias("most")
    ).first()
    width = -(-(widest.n or 1) // parts)
    bound = abs(_whole(-(widest.most or 0.0), scale)) + 1
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    rows = [[_whole(x, scale) for x in r.vector] for r in first]
    rows = [r + [0] * (parts * width - len(r)) for r in rows]
    books = [[r[p * width : (p + 1) * width] for r in rows] for p in range(parts)]
    digits = max(1, -(-(bound.bit_length() + 1) // DIGIT_BITS))
    return Codebooks(books, width, scale, digits, bound * width < 1 << 29)


def refine(kept: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry becomes the mean of its parts, rounded down; unused entries stay."""
    size = max(map(len, books.entries), default=0)
    if not size:
        return books
    stride, mask = 1 + books.width * books.digits, (1 << DIGIT_BITS) - 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_books = books.sorted_books()
        total = np.zeros((books.parts, size, stride), np.int64)
        for batch in batches:
            table = part_integers(batch.column(0), books.parts, books.width, books.scale, books.plain)
            for p, book in enumerate(sorted_books):
                name, _ = book.nearest(table[:, p])
                np.add.at(total[p, :, 0], name, 1)
                rest = table[:, p]
                for d in range(books.digits):
                    digit = rest if d == books.digits - 1 else rest & mask
                    np.add.at(total[p, :, 1 + d * books.width : 1 + (d + 1) * books.width], name, digit.astype(np.int64))
                    rest = rest >> DIGIT_BITS
        flat = total.ravel()
        slots = np.flatnonzero(flat)
        yield pa.record_batch([pa.array(slots, pa.int64()), pa.array(flat[slots], pa.int64())], ["slot", "amount"])

    partial = kept.select("vector").mapInArrow(sums, "slot bigint, amount bigint")
    found = {r.slot: r.amount for r in partial.groupBy("slot").agg(F.sum("amount").alias("amount")).collect()}

    def entry(p: int, e: int) -> list[int]:
        base = (p * size + e) * stride
        count = found.get(base, 0)
        if not count:
            return books.entries[p][e]
        place = lambda d, x: found.get(base + 1 + d * books.width + x, 0) << (DIGIT_BITS * d)
        return [sum(place(d, x) for d in range(books.digits)) // count for x in range(books.width)]

    refined = [[entry(p, e) for e in range(len(part))] for p, part in enumerate(books.entries)]
    return Codebooks(refined, books.width, books.scale, books.digits, books.plain)


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks after some rounds. ``entries`` may be 256 at most, so that a number has two hex digits."""
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    books = initial_codebooks(kept, parts, entries, scale)
    for _ in range(rounds):
        books = refine(kept, books)
    return books


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """Rows (vec_id, label, code, error): numbers in part order, and the sum of squared distances."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_books = books.sorted_books()
        for batch in batches:
            if not batch.num_rows:
                continue
            table = part_integers(batch.column("vector"), books.parts, books.width, books.scale, books.plain)
            names = np.zeros((batch.num_rows, books.parts), np.uint8)
            error = np.zeros(batch.num_rows, table.dtype)
            for p, book in enumerate(sorted_books):
                name, distance = book.nearest(table[:, p])
                names[:, p] = name
                error = error + distance
            code = [row.tobytes().hex() for row in names]
            clipped = [min(int(e), LARGEST) for e in error]
            yield pa.record_batch(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(clipped, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    kind = kept.schema["label"].dataType.simpleString()
    return kept.mapInArrow(codes, f"vec_id bigint, label {kind}, code string, error bigint")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add ``label_error``: the error summed over rows of the same label, null labels together.

    The codes are stored once and read twice. Sums are made before the join, whose right side has one row
    per label and is stored too, so that its real size decides about a broadcast.
    """
    coded = cut_lineage(coded)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    sums = cut_lineage(coded.groupBy(F.col("label").alias("summed_label")).agg(total.alias("label_error")))
    return coded.join(sums, coded["label"].eqNullSafe(sums["summed_label"]), "left").drop("summed_label")
