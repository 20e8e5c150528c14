"""Language identification by nearest centroids.

A text in lower case is a vector of counts of its n-grams of one to three bytes, where every ASCII
character that is no letter counts as a space and n-grams with two spaces together are
left out; they are hashed into a fixed number of places, weighted by TF-IDF and normalised. Several centroids per language come from k-means over its training vectors, by
cosine. A text gets the language of its nearest centroid; if even that is too far away,
the prediction is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillscope.scale import cut_lineage

from .text import mix, text_slices

PLACES_BITS = 12
SIZES = (1, 2, 3)
CENTROIDS = 4
TURNS = 15
# Training texts per language for the centroids: those first in hash order.
TEXTS_PER_LANGUAGE = 2000
# A nearest centroid with a smaller cosine is too far.
REJECT_BELOW = 0.25
UNDEFINED = "und"
_LETTERS = np.frombuffer(bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)), np.uint8)


class Model(NamedTuple):
    languages: list[str]
    owners: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray


def ngram_counts(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each text: counts of its hashed byte n-grams."""
    if not len(data):
        for _ in offsets[1:]:
            yield np.zeros(1 << PLACES_BITS)
        return
    folded = _LETTERS[data].astype(np.uint64)
    space = folded == 0x20
    places, counted = [], []
    for n in SIZES:
        key = np.full(len(folded) - n + 1 if len(folded) >= n else 0, n, np.uint64)
        for k in range(n):
            key = key * np.uint64(257) + folded[k : k + len(key)]
        places.append((mix(key) >> np.uint64(64 - PLACES_BITS)).astype(np.int32))
        whole = ~space if n == 1 else np.ones(len(key), bool)
        for k in range(n - 1):
            whole &= ~(space[k : k + len(key)] & space[k + 1 : k + 1 + len(key)])
        counted.append(whole)
    for a, b in zip(offsets[:-1], offsets[1:]):
        total = np.zeros(1 << PLACES_BITS)
        for n, place, whole in zip(SIZES, places, counted):
            if b - a >= n:
                total += np.bincount(place[a : b - n + 1], weights=whole[a : b - n + 1], minlength=1 << PLACES_BITS)
        yield total


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows; a row without n-grams stays zero."""
    weighted = np.log1p(counts) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


def _count_rows(texts: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, np.ndarray]]:
    """Runs of rows with their count vectors, at most 128 at once."""
    for first, _, data, offsets in text_slices(texts, column):
        held, start = [], first
        for row, counts in enumerate(ngram_counts(data, offsets), first):
            held.append(counts)
            if len(held) == 128:
                yield start, np.stack(held)
                held, start = [], row + 1
        if held:
            yield start, np.stack(held)


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each place occurs, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(1 << PLACES_BITS, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, counts in _count_rows(batch):
                found += (counts > 0).sum(0)
        # The number of rows travels as one more place.
        yield pa.record_batch([pa.array(np.arange(len(found) + 1, dtype=np.int32)), pa.array(np.append(found, rows))], names=["place", "n"])

    sums = texts.select("text").mapInArrow(run, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros((1 << PLACES_BITS) + 1, np.int64)
    found[sums.column("place").to_numpy()] = sums.column("n").to_numpy()
    return found[:-1], int(found[-1])


def cluster(vectors: np.ndarray, count: int) -> np.ndarray:
    """Centroids of unit vectors by cosine: k-means that starts from far-apart rows."""
    count = min(count, len(vectors))
    chosen = [0]
    near = vectors @ vectors[0]
    while len(chosen) < count:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(TURNS):
        owner = (vectors @ centroids.T).argmax(1)
        fresh = np.stack([vectors[owner == k].sum(0) if (owner == k).any() else centroids[k] for k in range(count)])
        fresh /= np.maximum(np.linalg.norm(fresh, axis=1, keepdims=True), 1e-12)
        if np.allclose(fresh, centroids):
            break
        centroids = fresh
    return centroids


def fit(
    docs: DataFrame,
    may_learn: Column,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    centroids: int = CENTROIDS,
    texts_per_language: int = TEXTS_PER_LANGUAGE,
) -> Model:
    """Learn from documents with text and lang for which ``may_learn`` holds.

    Document frequencies cover all of them; the centroids of a language are clustered from at most
    ``texts_per_language`` texts, those first in hash order. A language is learned in one task, which
    holds no more than these. Without any such document there are no languages.
    """
    known = docs.where(may_learn & docs[lang].isNotNull() & docs[text].isNotNull()).select(
        docs[lang].cast("string").alias("lang"), F.lower(docs[text].cast("string")).alias("text"), F.xxhash64(docs[key], docs[text]).alias("order")
    )
    seen, rows = _document_frequencies(known)
    idf = np.log((1 + rows) / (1 + seen)) + 1
    # The n-th smallest hash of a language bounds its sample; hashes are collected, texts are not.
    bounds = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), F.lit(2.0 * texts_per_language) / F.col("n"))
    part = (F.pmod("order", F.lit(1 << 20)) / (1 << 20)).cast("double")
    candidates = known.join(F.broadcast(bounds.orderBy(F.desc("n"), "lang").limit(10_000)), "lang").where(part <= share)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, counts in _count_rows(batch):
                found = _vectors(counts, idf).astype(np.float32)
                yield pa.record_batch(
                    [*(batch.column(c).slice(start, len(found)) for c in ("lang", "order")), pa.array([v.tobytes() for v in found], pa.binary())],
                    names=["lang", "order", "vector"],
                )

    # Vectors have one size, whatever the texts' lengths.
    sample = candidates.select("lang", "order", "text").mapInArrow(vectors, "lang string, order bigint, vector binary")
    first = sample.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("order", "vector")))
    sample = cut_lineage(first.where(F.col("rank") <= texts_per_language).select("lang", "order", "vector"))

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("vector", "ascending")])
        rows = np.stack([np.frombuffer(v.as_py(), np.float32) for v in table.column("vector")])
        rows = rows[np.linalg.norm(rows, axis=1) > 0]
        found = cluster(rows, centroids) if len(rows) else rows
        name = table.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([name] * len(found), pa.string()), "centroid": pa.array([c.astype(np.float64) for c in found], pa.list_(pa.float64()))})

    learned = sample.groupBy("lang").applyInArrow(learn, "lang string, centroid array<double>").orderBy("lang", "centroid").collect()
    languages = sorted({r["lang"] for r in learned})
    owners = np.array([languages.index(r["lang"]) for r in learned], np.int64)
    return Model(languages, owners, np.array([r["centroid"] for r in learned]).reshape(len(learned), 1 << PLACES_BITS), idf)


def predict(docs: DataFrame, model: Model, text: str = "text", name: str = "language") -> DataFrame:
    """Add a struct column ``name``: lang, score (0 to 1), rejected.

    lang is the language of the nearest centroid; ``und`` for a null text, a text without a
    letter, or without any learned language (score 0, rejected). score is the cosine; rejected says
    that it is below ``REJECT_BELOW``. All rows and columns stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double, rejected boolean")
    def nearest(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for array in texts:
            lang, score = np.full(len(array), -1), np.zeros(len(array))
            for start, counts in _count_rows(pa.record_batch([array], names=["text"])):
                if len(m.owners):
                    cosine = _vectors(counts, m.idf) @ m.centroids.T
                    best = cosine.argmax(1)
                    lang[start : start + len(counts)] = m.owners[best]
                    score[start : start + len(counts)] = cosine[np.arange(len(best)), best]
            names = pa.array([m.languages[i] if i >= 0 else UNDEFINED for i in lang], pa.string())
            score = np.clip(score, 0, 1)
            yield pa.StructArray.from_arrays([names, pa.array(score), pa.array(score < REJECT_BELOW)], names=["lang", "score", "rejected"])

    body = docs[text].cast("string")
    none = F.struct(F.lit(UNDEFINED).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    has_letter = F.coalesce(body.rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(name, F.when(has_letter, nearest(F.lower(body))).otherwise(none))
