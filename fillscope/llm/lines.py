"""Line dedup: lines that many documents share stay in one document only.

Only hashes move. Lines of documents are range-partitioned by (hash, document), so that the places of
a line which a third of all documents holds are collected in many tasks, one group per line and document.
Common lines are found by a pre-aggregated count and largest document per line, and joined back; the order
of the ranges decides nothing. The result is one bitmap of dropped
lines per document; texts never move for the search.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillscope.scale import cut_lineage

from .text import ascii_lower

MIN_CHARS, MIN_DOCS = 40, 5
WHITE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return ascii_lower(F.trim(line, F.lit(WHITE)))


def text_lines(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def text_id(text: Column) -> Column:
    """Tells apart rows with one document id and different texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def dropped_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Bitmaps of the lines that go, for documents that lose any.

    Keys (see ``line_key``) of at least ``min_chars`` code points found in at least
    ``min_docs`` documents lose all their lines except those of the largest document id.

    Returns key, text_id, n_dropped, dropped (array<bigint>; bit p % 64 of element p / 64 is line
    p; elements after the last dropped line are left out). Rows are one per document and
    distinct text. Rows without an id count as one document, smaller than all others; they lose
    lines like others. Repeated rows count once.
    """
    doc, body = docs[key], docs[text].cast("string")
    # Positions are found before hashing, so that only long lines are normalised.
    lines = (
        docs.select(doc.alias("doc"), text_id(body).alias("text_id"), F.posexplode(text_lines(body)).alias("pos", "line"))
        .where(F.char_length("line") >= min_chars)
        .select("doc", "text_id", "pos", line_key(F.col("line")).alias("line"))
        .where(F.char_length("line") >= min_chars)
        .select("doc", "text_id", "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))
    )
    ranged = lines.repartitionByRange("a", "b", "doc").sortWithinPartitions("a", "b", "doc", "text_id", "pos")
    # Stored, as it is read twice: once to find common lines, once to drop them. Rows without an id, which may be
    # many, are grouped by text: no group holds more than one document's places.
    apart = F.when(F.col("doc").isNull(), F.col("text_id")).alias("apart")
    places = cut_lineage(ranged.groupBy("a", "b", "doc", apart).agg(F.collect_set(F.struct("text_id", "pos")).alias("places")))
    # Stored, so that the join below meets two plain tables and can split a hot line.
    common = cut_lineage(
        places.groupBy("a", "b")
        .agg((F.count("doc") + F.max(F.col("doc").isNull().cast("int"))).alias("n"), F.max("doc").alias("last"))
        .where(F.col("n") >= min_docs)
        .select("a", "b", "last")
    )
    goes = (
        places.join(common, ["a", "b"])
        .where(F.col("doc").isNull() | (F.col("doc") != F.col("last")))
        .select("doc", F.explode("places").alias("place"))
        .select("doc", "place.text_id", F.floor(F.col("place.pos") / 64).cast("int").alias("word"), (F.col("place.pos") % 64).alias("bit"))
    )
    # Which lines go is a set of bits: each row sets its own.
    words = goes.groupBy("doc", "text_id", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    return (
        words.groupBy("doc", "text_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("bits"), F.max("word").alias("last"), F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"))
        .select(
            F.col("doc").alias(key),
            "text_id",
            "n_dropped",
            F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.coalesce(F.try_element_at("bits", i), F.lit(0).cast("long"))).alias("dropped"),
        )
    )


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines whose bit is not set, joined again; null bitmaps drop nothing."""

    def stays(_, i):
        word = F.get(dropped, F.floor(i / 64).cast("int"))
        return word.isNull() | (F.getbit(word, i % 64) == 0)

    body = F.coalesce(text, F.lit(""))
    return F.when(dropped.isNull(), body).otherwise(F.array_join(F.filter(text_lines(text), stays), "\n"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """Documents with n_lines, n_dropped and kept_text added; all rows and columns stay.

    Null texts count as empty and get an empty kept_text. A document whose lines all go
    stays with an empty text. Columns of these names are replaced.
    """
    # Names that no input has.
    own = [f"{name}_{uuid.uuid4().hex}" for name in ("doc", "text", "n", "bits")]
    found = dropped_lines(docs, key, text, **limits)
    gone = found.select(*[F.col(c).alias(name) for c, name in zip((key, "text_id", "n_dropped", "dropped"), own)])
    body = docs[text].cast("string")
    joined = docs.join(gone, docs[key].eqNullSafe(F.col(own[0])) & (text_id(body) == F.col(own[1])), "left")
    return joined.withColumns(
        {
            "n_lines": F.size(text_lines(body)).cast("long"),
            "n_dropped": F.coalesce(F.col(own[2]), F.lit(0).cast("long")),
            "kept_text": kept_text(body, F.col(own[3])),
        }
    ).drop(*own)
