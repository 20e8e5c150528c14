"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of consecutive words of a benchmark item. For patterns of one
length, the shift table says how far the search may move on when the block of
words that ends at the present position is not the end of any pattern; buckets by the
last block hold the patterns to compare directly where the shift is zero.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import ALNUM, split_words, word_array, ascii_lower

WINDOW = 10
# Words of benchmark text searched for in one pass over the documents; a larger benchmark
# is searched in several passes, so what a task holds never grows with it.
PASS_WORDS = 1_000_000


class Patterns:
    """The search tables for patterns of one length."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], list[int]]):
        self.length = length
        self.block = min(2, length)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list[int]]]] = defaultdict(list)
        self.far = length - self.block + 1
        for words, items in windows.items():
            for end in range(self.block, length + 1):
                block = words[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.far), length - end)
            self.buckets[words[length - self.block :]].append((words, items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """Each occurrence: its first word and the items of its pattern."""
        shift, far, block, length = self.shift, self.far, self.block, self.length
        position, count = length, len(words)
        get = shift.get
        while position <= count:
            suffix = tuple(words[position - block : position])
            move = get(suffix, far)
            if move:
                position += move
                continue
            begin = position - length
            for pattern, items in self.buckets[suffix]:
                if all(words[begin + i] == w for i, w in enumerate(pattern)):
                    yield begin, items
            position += 1


def search_tables(items: Iterable[tuple[int | None, str | None]], window: int = WINDOW) -> tuple[list[Patterns], list]:
    """Search tables for (item id, text) rows, and the ids they refer to by position."""
    ids: list = []
    places: dict = {}
    by_length: dict[int, dict[tuple[bytes, ...], list[int]]] = defaultdict(dict)
    for item, text in items:
        words = split_words(text, ALNUM)
        if not words:
            continue
        if item not in places:
            places[item] = len(ids)
            ids.append(item)
        length = min(window, len(words))
        for i in range(len(words) - length + 1):
            owners = by_length[length].setdefault(tuple(words[i : i + length]), [])
            if places[item] not in owners:
                owners.append(places[item])
    return [Patterns(n, found) for n, found in sorted(by_length.items())], ids


def scan(words: list[bytes], tables: list[Patterns]) -> tuple[list[tuple[int, int]], set[int]]:
    """Disjoint ascending [begin, end) ranges of hit words, and the items found."""
    spans: list[tuple[int, int]] = []
    found: set[int] = set()
    for table in tables:
        for begin, items in table.find(words):
            spans.append((begin, begin + table.length))
            found.update(items)
    return merge(spans), found


def merge(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Join overlapping and touching ranges."""
    merged: list[list[int]] = []
    for begin, end in sorted(spans):
        if merged and begin <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([begin, end])
    return [tuple(x) for x in merged]


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)
_ARROW = pa.schema(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.int64())),
    ]
)


def _passes(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows in groups of about ``limit`` words."""
    rows = benchmark.select(benchmark[item].cast("long").alias("item"), benchmark[text].alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.size(word_array(ascii_lower(F.col("text")))))).first()[0] or 0
    groups = -(-int(total) // limit)
    for k in range(groups):
        part = rows if groups == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == k)
        yield [(r["item"], r["text"]) for r in part.collect()]


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    pass_words: int = PASS_WORDS,
    name: str = "found",
) -> DataFrame:
    """Add a struct column ``found``: n_words, spans of hit words, and the items found.

    All columns and rows of ``docs`` stay, repeated rows too; a column called ``name`` is replaced. Null and empty
    texts have no words and no hits; items without words are not searched for. Rows with one
    id are one item; words of items without an id are hit like others, but these are no items found.
    Without any item there are no hits. Items are ascending.
    """
    groups = list(_passes(benchmark, item, item_text, pass_words)) or [[]]
    body = docs[text].cast("string")
    finders = [_finder(docs.sparkSession.sparkContext.broadcast(rows), window)(body) for rows in groups]
    if len(finders) == 1:
        return docs.withColumn(name, finders[0])
    # Names that no input has.
    own = [f"pass_{uuid.uuid4().hex}" for _ in finders]
    plain = docs.select("*", *[finder.alias(column) for finder, column in zip(finders, own)])
    parts = [F.col(column) for column in own]
    together = F.struct(
        parts[0]["n_words"].alias("n_words"),
        _union(F.flatten(F.array(*[p["spans"] for p in parts]))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.array(*[p["items"] for p in parts])))).alias("items"),
    )
    return plain.withColumn(name, together).drop(*own)


def _union(spans):
    """Join overlapping and touching ranges of an array of ranges."""

    def step(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"))
        more = F.concat(done, F.array(span))
        return F.when((F.size(done) > 0) & (span["begin"] <= F.try_element_at(done, F.lit(-1))["end"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(more)

    empty = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    return F.aggregate(F.array_sort(spans), empty, step)


def _finder(shared, window: int):
    @F.arrow_udf(FOUND)
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables, ids = search_tables(shared.value, window)
        for array in texts:
            n_words, spans, items = [], [], []
            for value in array:
                words = split_words(value.as_py())
                hit, which = scan(words, tables)
                n_words.append(len(words))
                spans.append([{"begin": a, "end": b} for a, b in hit])
                items.append(sorted(ids[i] for i in which if ids[i] is not None))
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip((n_words, spans, items), _ARROW)], fields=list(_ARROW)
            )

    return found
