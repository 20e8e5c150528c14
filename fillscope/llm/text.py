"""Text helpers shared by the operators: column expressions and vectorised byte kernels.

The kernels work on the UTF-8 bytes of many documents at once. They are small numpy
helpers that run inside tasks; Spark decides which documents meet in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything that is not part of a word of letters and digits; all of U+0080 and above is.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Documents of a batch are handled together up to about so many bytes of text.
SLICE_BYTES = 1 << 20


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` is fast and the same thing for ASCII text; only other text needs ``translate``.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_array(text: Column) -> Column:
    """Words of letters and digits; null text has none.

    ``text`` must be in lower case already (see ``ascii_lower``).
    """
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def byte_table(word_bytes: bytes) -> bytes:
    """A table for ``bytes.translate``: A-Z to lower case, bytes outside words to a space."""
    keep = set(word_bytes)
    lowered = bytes(range(256)).lower()
    return bytes(b if b in keep else 0x20 for b in lowered)


# Words of letters, digits and non-ASCII characters.
ALNUM = byte_table(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
# Words between ASCII white space.
NON_SPACE = byte_table(bytes(b for b in range(256) if b not in (0x20, 9, 10, 11, 12, 13)))


def split_words(text: str | None, table: bytes = ALNUM) -> list[bytes]:
    """The words of one text as UTF-8 bytes; none for a null."""
    return text.encode().translate(table).split() if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


mix = _mix
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """The first n powers of the base or of its inverse, modulo 2^64."""
    if len(_powers[kind]) < n:
        steps = np.full(n, _BASE if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps)
    return _powers[kind][:n]


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word of many texts, and where each text's words begin.

    ``data`` holds the translated bytes (words and spaces) of the texts one after
    another, ``offsets`` (n + 1 entries) where they begin; the last result has n + 1 entries, too.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = data != 0x20
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(begin, offsets)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, which depend on their bytes only.

    Each is the difference of two prefix sums of a polynomial, moved to the word's beginning.
    """
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * _power("up", len(data)), out=sums[1:])
    return _mix((sums[end] - sums[begin]) * _power("down", len(data))[begin])


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of translated texts, and offsets of each text's words."""
    begin, end, places = word_places(data, offsets)
    return (word_hashes(data, begin, end) if len(begin) else np.zeros(0, np.uint64)), places


def text_slices(
    batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text.

    Yields the first row, the row after the last, the bytes of the run, and the
    rows' offsets in them. A null text is empty. One text longer than the limit
    is a run of its own.
    """
    array = batch.column(column)
    array = array.cast(pa.large_string()).fill_null("")
    if not len(array):
        return
    ends = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(array):
        stop = int(np.searchsorted(ends, ends[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), len(array))
        yield row, stop, data[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop


def hashed_words(data: np.ndarray, offsets: np.ndarray, table: bytes = ALNUM):
    """``hash_words`` of raw text bytes."""
    return hash_words(np.frombuffer(table, np.uint8)[data], offsets)


# Bits of a filter made from keys: fixed, whatever the number of keys.
FILTER_BITS = 24


def may_hold(keys: DataFrame, column: str, probe: Column) -> Column:
    """A condition that is true where ``probe`` is among the keys, and seldom elsewhere.

    It spares rows without a partner their way through a shuffle; the join that follows
    decides. The filter's size is fixed; with very many keys it lets all rows pass.
    """

    def slot(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))

    bits = (
        keys.select(slot(F.col(column)).alias("slot"))
        .groupBy(F.floor(F.col("slot") / 64).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[bits.column("word").to_numpy()] = bits.column("bits").to_numpy()
    shared = keys.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("boolean")
    def holds(slots: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in slots:
            where = array.to_numpy(zero_copy_only=False)
            yield pa.array((shared.value[where >> 6] >> (where & 63)) & 1 == 1)

    return holds(slot(probe))
