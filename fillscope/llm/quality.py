"""Text quality from weak labels.

Simple heuristics vote good, bad or nothing on every text. Expectation-maximisation estimates each
one's accuracy from their agreement alone: the votes of all documents are counted by
pattern, of which there is a fixed number. The posterior of a document's pattern is its
label; a linear scorer over hashed features of the text learns these labels and
scores all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import NON_SPACE, hashed_words, mix, text_slices

# Measure; bad below, good from, good up to, bad above. A value between says nothing. Most
# heuristics know one fault only and never vote good: good from is above good up to.
HEURISTICS = (
    ("symbols", -1.0, 1.0, 0.0, 0.06),
    ("upper", -1.0, 1.0, 0.0, 0.5),
    ("different", 0.3, 1.0, 0.0, 2.0),
    ("repeated", -1.0, 1.0, 0.0, 0.15),
    ("word_length", 2.0, 3.0, 9.0, 14.0),
    ("letters", 0.75, 0.93, 1.0, 2.0),
    ("stops", -1.0, 0.02, 0.3, 1.0),
)
# A vote is at least so many times as likely for its own class as for the other.
LEAST_WORTH = 3.0
ABSTAIN, BAD, GOOD = 0, 1, 2
PATTERNS = 3 ** len(HEURISTICS)
FEATURE_BITS = 11
# Texts the scorer learns from: the first in hash order.
TRAINING_TEXTS = 6000
TURNS = 100
MIN_WORDS = 4


def _is(characters: str) -> np.ndarray:
    return np.array([chr(b) in characters and b < 0x80 for b in range(256)])


_SYMBOL, _STOP = _is("#$%&*|<>=+@^~{}[]_\\"), _is(".?!;")
_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: a column per heuristic, then the number of words."""
    words, places = hashed_words(data, offsets, NON_SPACE)
    count = np.diff(places)

    def sums(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    spaces = np.frombuffer(NON_SPACE, np.uint8) == 0x20
    solid = sums(_LEAD & ~spaces)
    again = np.zeros(len(words), np.int64)
    again[1:] = words[1:] == words[:-1]
    starts = places[:-1][count > 0]
    again[starts] = 0
    again = np.concatenate([[0], np.cumsum(again)])
    different = np.array([len(np.unique(words[a:b])) for a, b in zip(places[:-1], places[1:])])
    # A long text repeats words by nature: its share of different words is taken over fifty at most.
    expected = np.maximum(np.minimum(count, 50), 1)
    ratio = lambda a, b: a / np.maximum(b, 1)
    return np.stack(
        [
            ratio(sums(_SYMBOL), solid),
            ratio(sums(_UPPER), sums(_LETTER)),
            np.minimum(different / expected, 1.0),
            ratio(again[places[1:]] - again[places[:-1]], count),
            ratio(solid, count),
            ratio(sums(_LETTER & _LEAD), solid),
            ratio(sums(_STOP), count),
            count,
        ],
        1,
    ).astype(np.float64)


def votes(found: np.ndarray) -> np.ndarray:
    """Votes of all heuristics as one number per text, to the base of three."""
    total = np.zeros(len(found), np.int64)
    short = found[:, -1] < MIN_WORDS
    for i, (_, bad_below, good_from, good_to, bad_above) in enumerate(HEURISTICS):
        x = found[:, i]
        # A text too short to judge gets no votes.
        vote = np.where(short, ABSTAIN, np.where((x < bad_below) | (x > bad_above), BAD, np.where((x >= good_from) & (x <= good_to), GOOD, ABSTAIN)))
        total = total * 3 + vote
    return total


def pattern_votes() -> np.ndarray:
    """The vote of each heuristic in each pattern."""
    numbers = np.arange(PATTERNS)
    return np.stack([numbers // 3 ** (len(HEURISTICS) - 1 - i) % 3 for i in range(len(HEURISTICS))], 1)


class Labels(NamedTuple):
    good: float
    accuracy: np.ndarray
    posterior: np.ndarray


def expectation_maximisation(counts: np.ndarray, turns: int = TURNS) -> Labels:
    """Share of good texts, P(vote | class) per heuristic, and the posterior of each pattern.

    Starts from most votes. Without any texts every posterior is one half.
    """
    vote = pattern_votes()
    share = ((vote == GOOD).sum(1) - (vote == BAD).sum(1)) / len(HEURISTICS)
    posterior = np.clip(0.5 + 0.5 * share, 0.05, 0.95)
    # Every bad vote weighs more at first: a text is usually bad in one way only.
    posterior = np.where((vote == BAD).any(1), np.minimum(posterior, 0.4), posterior)
    total = counts.sum()
    if not total:
        return Labels(0.5, np.full((2, len(HEURISTICS), 3), 1 / 3), np.full(PATTERNS, 0.5))
    for _ in range(turns):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        good = float(np.clip(weight[1].sum() / total, 1e-3, 1 - 1e-3))
        table = np.stack([np.stack([(weight * (vote[:, i] == v)).sum(1) for v in range(3)], 1) for i in range(len(HEURISTICS))], 1) + 1.0
        table /= table.sum(2, keepdims=True)
        for vote_of, own in ((BAD, 0), (GOOD, 1)):
            table[1 - own, :, vote_of] = np.minimum(table[1 - own, :, vote_of], table[own, :, vote_of] / LEAST_WORTH)
        like = np.stack([np.log(table[c][np.arange(len(HEURISTICS)), vote]).sum(1) for c in (0, 1)])
        odds = like[1] - like[0] + np.log(good / (1 - good))
        fresh = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        if np.abs(fresh - posterior).max() < 1e-9:
            break
        posterior = fresh
    return Labels(good, table, posterior)


def hashed_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of hashed features: byte triples as they are, and named levels of the measures."""
    size = 1 << FEATURE_BITS
    found = measures(data, offsets)
    rows = np.zeros((len(found), size), np.float32)
    if len(data) >= 3:
        raw = data.astype(np.uint64)
        place = (mix(raw[:-2] << np.uint64(16) | raw[1:-1] << np.uint64(8) | raw[2:]) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            if b - a >= 3:
                rows[i] = np.log1p(np.bincount(place[a : b - 2], minlength=size))
        rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    for i, (_, bad_below, good_from, good_to, bad_above) in enumerate(HEURISTICS):
        level = np.digitize(found[:, i], sorted({bad_below, good_from, (good_from + bad_above) / 4, good_to, bad_above}))
        name = mix(np.uint64(1000 * (i + 1)) + level.astype(np.uint64)) >> np.uint64(64 - FEATURE_BITS)
        rows[np.arange(len(rows)), name.astype(np.int64)] += 0.5
    return rows


def train_linear(rows: np.ndarray, target: np.ndarray, turns: int = 60, ridge: float = 1e-4) -> np.ndarray:
    """Weights (the bias last) of a logistic regression on soft labels, both classes weighing alike."""
    x = np.concatenate([rows, np.ones((len(rows), 1), np.float32)], 1)
    balance = np.where(target >= 0.5, 0.5 / max((target >= 0.5).sum(), 1), 0.5 / max((target < 0.5).sum(), 1))
    w = np.zeros(x.shape[1])
    step = np.zeros_like(w)
    for turn in range(turns * 5):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (balance * (p - target)) + ridge * np.append(w[:-1], 0)
        step = 0.9 * step - 4.0 * gradient
        w = w + step
    return w


class Model(NamedTuple):
    labels: Labels
    weights: np.ndarray


def _slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of at most 1024 rows."""
    for first, stop, data, offsets in text_slices(batch, column):
        for a in range(0, stop - first, 1024):
            b = min(a + 1024, stop - first)
            yield first + a, first + b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Accuracies from the votes on all documents; weights from a bounded sample of ``TRAINING_TEXTS``.

    Null texts count as empty. Without documents all scores are one half.
    """
    texts = docs.select(F.xxhash64(docs[key], docs[text]).alias("order"), docs[text].cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PATTERNS, np.int64)
        for batch in batches:
            for _, _, data, offsets in _slices(batch):
                total += np.bincount(votes(measures(data, offsets)), minlength=PATTERNS)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["pattern", "n"])

    sums = texts.select("text").mapInArrow(count, "pattern int, n bigint").groupBy("pattern").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(PATTERNS)
    counts[sums.column("pattern").to_numpy()] = sums.column("n").to_numpy()
    labels = expectation_maximisation(counts)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in _slices(batch):
                rows = hashed_features(data, offsets).astype(np.float16)
                goal = labels.posterior[votes(measures(data, offsets))]
                yield pa.record_batch(
                    [batch.column(0).slice(first, stop - first), pa.array([r.tobytes() for r in rows], pa.binary()), pa.array(goal)],
                    names=["order", "row", "goal"],
                )

    total = int(counts.sum())
    share = min(1.0, 1.5 * TRAINING_TEXTS / max(total, 1))
    part = (F.pmod("order", F.lit(1 << 30)) / (1 << 30)).cast("double")
    # Rows of features have one size; texts are neither ordered nor collected.
    chosen = texts.where(part <= share).mapInArrow(learn, "order bigint, row binary, goal double")
    sample = chosen.orderBy("order", "row").limit(TRAINING_TEXTS).toArrow()
    weights = np.zeros((1 << FEATURE_BITS) + 1)
    if sample.num_rows:
        rows = np.stack([np.frombuffer(r.as_py(), np.float16) for r in sample.column("row")]).astype(np.float32)
        weights = train_linear(rows, sample.column("goal").to_numpy())
    return Model(labels, weights)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "quality") -> DataFrame:
    """Add a struct column ``name``: score (0 to 1, higher is better) and weak_label (the posterior).

    All rows and columns stay; null texts count as empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("score double, weak_label double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for array in texts:
            out = np.zeros((2, len(array)))
            for first, stop, data, offsets in _slices(pa.record_batch([array], names=["text"])):
                linear = hashed_features(data, offsets) @ m.weights[:-1] + m.weights[-1]
                out[0, first:stop] = 1 / (1 + np.exp(-np.clip(linear, -30, 30)))
                out[1, first:stop] = m.labels.posterior[votes(measures(data, offsets))]
            yield pa.StructArray.from_arrays([pa.array(out[0]), pa.array(out[1])], names=["score", "weak_label"])

    return docs.withColumn(name, scored(docs[text].cast("string")))
