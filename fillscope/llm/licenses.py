"""License scans by diagonal voting.

All pairs of adjacent words of a document are hashed and joined to the pairs of license
templates. Each hit votes for the diagonal (place in the document minus place in the
template) it lies on; votes are counted per diagonal, neighbouring diagonals (small
insertions and deletions) are merged, and the resulting spans are verified. DataFrame
functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .text import word_array


class Template(NamedTuple):
    """A text to look for: at least two lower-case words of letters and digits.

    ``gap``: diagonals up to so many words apart are one span. ``cover``: the share of the template's word
    pairs that a span must hold.
    """

    label: str
    words: str
    gap: int = 0
    cover: float = 1.0


BASE = (
    Template("mit", "mit license"),
    Template("apache", "apache license"),
    Template("gpl", "general public license"),
)
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", 2, 0.8),
    Template("mit-notice", "released under the mit license", 1, 0.75),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", 2, 0.8),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", 1, 0.8),
    Template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", 2, 0.8),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy", 2, 0.8),
    Template("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted", 2, 0.8),
)
TEMPLATES = BASE + NOTICES
# Templates are a parameter, not data; beyond so many words they are not broadcast but refused.
MAX_TEMPLATE_WORDS = 20_000


def _gram(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def template_grams(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row per pair of adjacent words: t (template number), t_pos, w1, w2, grams, gap, cover, label."""
    rows = []
    for t, template in enumerate(templates):
        words = template.words.split()
        if len(words) < 2:
            raise ValueError(f"template {template.label} has fewer than two words")
        for i in range(len(words) - 1):
            rows.append((t, i, words[i], words[i + 1], len(words) - 1, template.gap, float(template.cover), template.label))
    if not rows or len(rows) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"{len(rows)} template words; between 1 and {MAX_TEMPLATE_WORDS} are possible")
    values = F.array(*[F.struct(*[F.lit(v) for v in row]) for row in rows])
    return spark.range(1).select(F.inline(values).alias("t", "t_pos", "w1", "w2", "grams", "gap", "cover", "label"))


def license_spans(
    docs: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, spans.

    spans: array of (label, first, last, votes, coverage), by first word, then label; first and last are word
    positions from 0. Null and empty texts have no words and an empty array. Repeated rows
    give a row each. A word that belongs to several templates counts for each.
    """
    # The Kelvin sign is the only other character that lower() turns into an ASCII letter alone.
    lowered = F.lower(F.replace(docs[text].cast("string"), F.lit("K"), F.lit("Å")))
    words = docs.select(F.monotonically_increasing_id().alias("row"), docs[key].alias("doc"), word_array(lowered).alias("words"))
    pairs = F.when(F.size("words") > 1, F.transform(F.sequence(F.lit(0), F.size("words") - 2), lambda i: _gram(F.get("words", i), F.get("words", i + 1))))
    grams = words.select("row", "doc", "words", F.posexplode_outer(pairs).alias("pos", "gram"))
    wanted = F.broadcast(template_grams(docs.sparkSession, templates).withColumn("t_gram", _gram(F.col("w1"), F.col("w2"))))
    # Equal hashes are compared word by word at once.
    hit = (F.col("gram") == F.col("t_gram")) & (F.get("words", F.col("pos")) == F.col("w1")) & (F.get("words", F.col("pos") + 1) == F.col("w2"))
    diagonals = (
        grams.join(wanted, hit, "left")
        .groupBy("row", "doc", "t", "label", "grams", "gap", "cover", (F.col("pos") - F.col("t_pos")).alias("diagonal"))
        .agg(
            F.max(F.size("words")).cast("long").alias("n_words"),
            F.count("t").alias("votes"),
            F.min("pos").cast("long").alias("first"),
            (F.max("pos") + 1).cast("long").alias("last"),
        )
    )
    order = W.partitionBy("row", "t").orderBy("diagonal")
    new = F.col("diagonal") - F.lag("diagonal").over(order) > F.col("gap")
    merged = (
        diagonals.withColumn("new", F.coalesce(new, F.lit(True)).cast("int"))
        .withColumn("group", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("row", "doc", "t", "label", "grams", "cover", "group")
        .agg(F.max("n_words").alias("n_words"), F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    coverage = F.least(F.lit(1.0), F.col("votes") / F.col("grams"))
    right = (coverage >= F.col("cover")) & (F.col("last") - F.col("first") <= F.col("grams") * 1.5)
    span = F.struct("first", "label", "last", "votes", coverage.alias("coverage"))
    return (
        merged.groupBy("row", "doc")
        .agg(F.max("n_words").alias("n_words"), F.array_sort(F.collect_list(F.when(F.col("t").isNotNull() & right, span))).alias("spans"))
        .select(F.col("doc").alias(key), "n_words", "spans")
    )
