"""Plain versions of the operators, and documents that hold every awkward case."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # Names that operators use inside.
        T.StructField("doc", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()),
    ]
)
SHARED = "This line is long enough to be shared by many documents, really."
BODY = " ".join(f"wort{i}" for i in range(60))


def _text(i: int) -> str:
    return f"{SHARED}\n{BODY} ende{i}\n  {SHARED.upper()}\t\nshort\n" + "x" * i


TEXTS = [
    None,
    "",
    "\n",
    " \t\x0b\x0c\r\n",
    "one",
    "Two Words",
    "ÀÉ kKlvin İ ß 中文 \U0001f926",
    "MIT License, mit\nlicense. Apache-License GNU General Public License general public",
    "permission is hereby granted free of any charge to any person obtaining a copy",
    *[_text(i) for i in range(7)],
    _text(3),
    "the same word " * 3000,
    "x" * 70_000,
    "a b c d e f g h i j k l",
    "A B C D E F G H I J K L",
    "a b c d e f g h i j k z",
]


def rows() -> list[tuple]:
    """The texts with ids, a repeated row, a repeated id, and rows without an id."""
    found = [(i, t, "xx" if i % 3 else None, "d", i, None) for i, t in enumerate(TEXTS)]
    return [*found, found[9], (9, "another text under a used id", None, None, None, 1), (None, _text(5), None, None, None, 1), (None, None, None, None, None, 1)]


def edge_documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text: str) -> str:
    return text.encode().lower().decode()


def alnum_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def line_dedup(docs: list[tuple]) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, kept text) of (doc_id, text) rows."""
    holders = defaultdict(set)
    key = lambda line: ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
    for doc, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(-1 if doc is None else doc)
    found = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(key(x)) < 40 or len(holders[key(x)]) < 5 or (-1 if doc is None else doc) == max(holders[key(x)])
        ]
        found.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return found


def shingles(text: str | None, words: int = 5) -> frozenset:
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def near_duplicates(docs: list[tuple], percent: int = 75) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    common = defaultdict(int)
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            for j in holders[g]:
                common[j, i] += 1
            holders[g].append(i)
    for (i, j), n in common.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            parent[root(i)] = root(j)
    smallest: dict[int, list] = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        smallest[root(i)].append(doc)
    least = lambda ids: min((d for d in ids if d is not None), default=None)
    return [(doc, len(sets[i]), least(smallest[root(i)]) if sets[i] else doc) for i, (doc, _) in enumerate(docs)]


def contamination(docs: list[tuple], items: list[tuple], size: int = 10) -> list[tuple]:
    """(doc_id, n_words, hit positions, item ids) of (doc_id, text) rows."""
    windows = defaultdict(set)
    for item, text in items:
        w = alnum_words(text)
        if not w:
            continue
        n = min(size, len(w))
        for i in range(len(w) - n + 1):
            windows[tuple(w[i : i + n])].add(item)
    lengths = {len(x) for x in windows}
    found = []
    for doc, text in docs:
        w = alnum_words(text)
        hit, ids = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[x]
        found.append((doc, len(w), hit, sorted(ids - {None})))
    return found


def ordered(found) -> list[tuple]:
    return sorted((tuple(r) for r in found), key=repr)
