"""Toxicity scores from two Kneser-Ney models, one of toxic and one of ordinary texts.

Both models spell words byte by byte from a word's beginning, so that forms never seen share what is known
of their parts. The highest order uses counts, lower orders the number of different
left neighbours (Kneser-Ney), and the lowest order is shared by both classes, so that
rare expressions are smoothed alike. A document's score comes from its log-likelihood ratio
per word: words that speak clearly for the toxic model, divided by all words.

Counts come from all labelled texts. They are kept in tables of fixed size (n-grams are hashed into
buckets), so the model that travels to the tasks does not grow with the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillscope.scale import cut_lineage

from .text import ALNUM, ascii_lower, may_hold, mix, text_slices, word_array, word_hashes, word_places

ORDER = 7
BUCKET_BITS = 18
DISCOUNT = 0.75
# A word speaks for the toxic model by what its log-likelihood ratio exceeds this.
MARGIN = 1.5
REJECT = 0.7
# Of the labelled rows that may be learned from, one in so many fits the scale of the score.
CALIBRATION_FOLDS = 5
# Bits of a worker's table of words already scored.
CACHE_BITS = 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class Tables(NamedTuple):
    """By order (from 2 on), class and bucket: n-gram counts, context totals, different followers."""

    grams: np.ndarray
    totals: np.ndarray
    kinds: np.ndarray


class Model(NamedTuple):
    """The tables, packed and broadcast once, and the scale of the score."""

    packed: Broadcast
    weights: np.ndarray


def pack(tables: Tables) -> bytes:
    """Tables as compressed logarithms of half precision; small counts stay exact."""
    return zlib.compress(np.log1p(np.stack(tables)).astype(np.float16).tobytes(), 1)


def unpack(packed: bytes) -> Tables:
    counts = np.frombuffer(zlib.decompress(packed), np.float16).astype(np.float32)
    np.expm1(counts, out=counts)
    np.rint(counts, out=counts, where=counts < 256)
    return Tables(*counts.reshape(3, ORDER - 1, 2, 1 << BUCKET_BITS))


def spell(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the given words, each with a space before it: codes, place in the word, word number."""
    size = end - begin + 1
    start = np.cumsum(size) - size
    word = np.repeat(np.arange(len(begin)), size)
    place = np.arange(int(size.sum())) - start[word]
    codes = np.where(place == 0, 0x20, data[np.minimum(begin[word] + place - 1, len(data) - 1)])
    return _LETTER[codes], place, word


def ngram_hashes(codes: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """For n from 1 to order: the hash of the n bytes that end at each place (garbage before a word's n-th byte)."""
    found, running = [], np.zeros(len(codes), np.uint64)
    for n in range(1, order + 1):
        older = np.zeros(len(codes), np.uint64)
        older[n - 1 :] = codes[: len(codes) - n + 1]
        running = running * _STEP + older
        found.append(mix(running + np.uint64(n)))
    return found


def _before(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros_like(hashes)
    out[1:] = hashes[:-1]
    return out


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with counts by class to n-grams: order, gram, context, shorter gram, anchored, counts."""
    for batch in batches:
        array = batch.column(0).cast(pa.large_string())
        ends = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
        data = np.frombuffer(array.buffers()[2], np.uint8)
        counts = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (1, 2)])
        codes, place, word = spell(data, ends[:-1], ends[1:])
        hashes = ngram_hashes(codes)
        for n in range(2, ORDER + 1):
            ok = place >= n - 1
            grams = hashes[n - 1][ok]
            _, at, back = np.unique(grams, return_index=True, return_inverse=True)
            sums = [np.bincount(back, weights=c[word[ok]], minlength=len(at)).astype(np.int64) for c in counts]
            context, shorter = _before(hashes[n - 2])[ok][at], hashes[n - 2][ok][at]
            yield pa.record_batch(
                [
                    pa.array(np.full(len(at), n, np.int32)),
                    pa.array(grams[at].view(np.int64)),
                    pa.array(context.view(np.int64)),
                    pa.array(shorter.view(np.int64)),
                    pa.array((place[ok] == n - 1)[at]),
                    *map(pa.array, sums),
                ],
                names=["n", "gram", "context", "shorter", "anchored", "n0", "n1"],
            )


def _tables(words: DataFrame) -> Tables:
    """Count tables from words (word, n0, n1)."""
    raw = words.select("word", "n0", "n1").mapInArrow(
        _count_grams, "n int, gram bigint, context bigint, shorter bigint, anchored boolean, n0 bigint, n1 bigint"
    )
    # Stored, as it is read three times.
    exact = cut_lineage(raw.groupBy("n", "gram", "context", "shorter", "anchored").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    kinds = [(F.col(c) > 0).cast("long").alias(c) for c in ("n0", "n1")]
    # Orders below the highest count their different left neighbours; words' beginnings have none.
    own = exact.where((F.col("n") == ORDER) | F.col("anchored")).select("n", "gram", "context", "n0", "n1")
    ahead = exact.where("n > 2").select((F.col("n") - 1).alias("n"), F.col("shorter").alias("gram"), *kinds).groupBy("n", "gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    inner = exact.where((F.col("n") < ORDER) & ~F.col("anchored")).select("n", "gram", "context").join(ahead, ["n", "gram"])
    both = cut_lineage(own.unionByName(inner))
    bucket = lambda c: F.call_function("shiftrightunsigned", F.col(c), F.lit(64 - BUCKET_BITS)).alias("bucket")
    sums = [F.sum(c).cast("double").alias(c) for c in ("n0", "n1")]
    seen = [F.sum((F.col(c) > 0).cast("long")).cast("double").alias("k" + c[1]) for c in ("n0", "n1")]
    shape = (ORDER - 1, 2, 1 << BUCKET_BITS)
    grams, totals, followers = np.zeros(shape, np.float32), np.zeros(shape, np.float32), np.zeros(shape, np.float32)
    for column, names, tables in (("gram", ("n0", "n1"), (grams,)), ("context", ("n0", "n1", "k0", "k1"), (totals, followers))):
        found = both.groupBy("n", bucket(column)).agg(*sums, *(seen if len(tables) == 2 else [])).toArrow()
        where = found.column("n").to_numpy() - 2, found.column("bucket").to_numpy()
        for i, name in enumerate(names):
            tables[i // 2][where[0], i % 2, where[1]] = found.column(name).to_numpy()
    # The lowest order is shared by the classes.
    for t in (grams, totals, followers):
        t[0] = t[0].sum(0, keepdims=True)
    return Tables(grams, totals, followers)


def word_ratios(tables: Tables, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio (toxic to ordinary) of each word."""
    if not len(begin):
        return np.zeros(0)
    codes, place, word = spell(data, begin, end)
    hashes = ngram_hashes(codes)
    likely = [np.full(len(codes), 1 / 64, np.float64), np.full(len(codes), 1 / 64, np.float64)]
    for n in range(2, ORDER + 1):
        at = np.flatnonzero(place >= n - 1)
        gram, context = _bucket(hashes[n - 1][at]), _bucket(hashes[n - 2][np.maximum(at - 1, 0)])
        for c in (0, 1):
            total = tables.totals[n - 2, c][context].astype(np.float64)
            known = total > 0
            base = np.maximum(total, 1)
            kept = np.maximum(tables.grams[n - 2, c][gram] - DISCOUNT, 0) / base
            spare = np.where(known, np.minimum(DISCOUNT * tables.kinds[n - 2, c][context] / base, 1), 1)
            likely[c][at] = kept + np.maximum(spare, 1e-6) * likely[c][at]
    ratio = np.where(place > 0, np.log(likely[1]) - np.log(likely[0]), 0.0)
    return np.bincount(word, weights=ratio, minlength=len(begin))


class Scorer:
    """Looks at texts with one model; remembers words in a table of fixed size."""

    def __init__(self, packed: bytes):
        self.tables = unpack(packed)
        self.names = np.zeros(1 << CACHE_BITS, np.uint64)
        self.known = np.zeros(1 << CACHE_BITS)

    def ratios(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        names = word_hashes(data, begin, end)
        slot = (names >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        out = self.known[slot]
        missing = np.flatnonzero(self.names[slot] != names)
        if len(missing):
            _, at, back = np.unique(names[missing], return_index=True, return_inverse=True)
            first = missing[at]
            fresh = word_ratios(self.tables, data, begin[first], end[first])
            out[missing] = fresh[back]
            self.names[slot[first]] = names[first]
            # Of two words in one slot the later stays.
            self.known[slot[first]] = fresh
        return out

    def features(self, batch: pa.RecordBatch, column: str = "text") -> np.ndarray:
        """Per row: words, clear evidence per word, clear evidence."""
        out = np.zeros((batch.num_rows, 3))
        table = np.frombuffer(ALNUM, np.uint8)
        for first, stop, data, offsets in text_slices(batch, column):
            data = table[data]
            begin, end, places = word_places(data, offsets)
            clear = np.maximum(self.ratios(data, begin, end) - MARGIN, 0)
            sums = np.concatenate([[0.0], np.cumsum(clear)])
            words = np.diff(places)
            total = sums[places[1:]] - sums[places[:-1]]
            out[first:stop] = np.stack([words, total / np.maximum(words, 1), total], 1)
        return out


def _terms(features: np.ndarray) -> np.ndarray:
    """What the scale of the score is fitted to."""
    return np.stack([np.ones(len(features)), np.log(features[:, 1] + 0.01), np.log1p(features[:, 0]), np.log1p(features[:, 2])], 1)


def _logistic(x: np.ndarray, y: np.ndarray, mass: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression of rows that count ``mass`` times each, by Newton's method."""
    w = np.zeros(x.shape[1])
    penalty = np.eye(x.shape[1]) * ridge
    penalty[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (mass * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (mass * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


# So many rows of each class fit the scale at most.
CALIBRATION_ROWS = 10_000
# The scale where the calibration fold lacks a class. No data went into it: log-odds rise with the logarithms of clear
# evidence per word and in all, alike, and are even at one nat in all and one tenth of a nat a word.
PLAIN_SCALE = np.array([-2 * np.log(0.11 * 2), 2.0, 0.0, 2.0])


def fit(
    docs: DataFrame, labels: DataFrame, may_learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model:
    """Learn from documents with a label (0 or 1) whose ``may_learn``, a condition on column ``key`` of the labels, holds.

    A label is dropped if it is null or not 0 or 1; of several labels of one key the largest counts.
    Four fifths of the keys give the counts, all of them; the scale of the score is fitted to the others, of each
    class the first 10,000 in hash order, weighted so that each class keeps its share. If either part lacks a class,
    all keys give the counts and the scale is a plain one. Without labels of both classes every score is 0.
    """
    known = (
        labels.where(may_learn & labels[key].isNotNull() & labels[label].isin(0, 1))
        .groupBy(labels[key].alias("_key"))
        .agg(F.max(labels[label]).cast("int").alias("_toxic"))
        .withColumn("_fold", F.pmod(F.xxhash64("_key"), F.lit(CALIBRATION_FOLDS)))
    )
    known = cut_lineage(known)
    texts = docs.select(docs[key].alias("_key"), docs[text].cast("string").alias("text"))
    rows = cut_lineage(texts.where(may_hold(known, "_key", F.col("_key"))).join(known, "_key"))
    held = {(r["fitting"], r["_toxic"]): r["n"] for r in rows.groupBy((F.col("_fold") == 0).alias("fitting"), "_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all(any((f, c) in held for f in (True, False)) for c in (0, 1)):
        return Model(_shared_counts(rows), np.array([-30.0, 0, 0, 0]))
    if len(held) < 4:
        return Model(_shared_counts(rows), PLAIN_SCALE)
    shared = _shared_counts(rows.where("_fold != 0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = scorer.features(batch)
            yield pa.record_batch([*batch.columns[:2], *[pa.array(found[:, i]) for i in range(3)]], names=["order", "toxic", "a", "b", "c"])

    # Only numbers are ordered and collected, never texts.
    chosen = rows.where("_fold = 0").select(F.xxhash64("_key").alias("order"), F.col("_toxic").alias("toxic"), "text")
    chosen = cut_lineage(chosen.mapInArrow(run, "order bigint, toxic int, a double, b double, c double"))
    samples = [chosen.where(F.col("toxic") == c).orderBy("order", "a", "b", "c").limit(CALIBRATION_ROWS).toPandas() for c in (0, 1)]
    x = np.concatenate([_terms(sample[["a", "b", "c"]].to_numpy(float)) for sample in samples])
    y = np.repeat([0.0, 1.0], [len(sample) for sample in samples])
    mass = np.repeat([held[True, c] / len(sample) for c, sample in enumerate(samples)], [len(sample) for sample in samples])
    return Model(shared, _logistic(x, y, mass * len(mass) / mass.sum()))


def _shared_counts(rows: DataFrame) -> Broadcast:
    """The packed count tables of labelled rows (_toxic, text), broadcast."""
    words = (
        rows.select("_toxic", F.explode(word_array(ascii_lower(F.col("text")))).alias("word"))
        .groupBy("word")
        .agg(*[F.sum((F.col("_toxic") == c).cast("long")).alias(f"n{c}") for c in (0, 1)])
    )
    return rows.sparkSession.sparkContext.broadcast(pack(_tables(words)))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity") -> DataFrame:
    """Add a column ``name``: double from 0 to 1, higher for texts more likely toxic.

    All rows and columns stay. Null texts count as empty; empty texts get a score too.
    """
    shared, weights = model

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for array in texts:
            found = scorer.features(pa.record_batch([array], names=["text"]))
            yield pa.array(1 / (1 + np.exp(-np.clip(_terms(found) @ weights, -30, 30))))

    return docs.withColumn(name, scored(docs[text].cast("string")))
