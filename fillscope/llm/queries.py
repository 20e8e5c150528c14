"""One query per operator, over whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    html_text,
    jaccard,
    language,
    licenses,
    lines,
    prefix_trie,
    quality,
    sentencepiece,
    sharding,
    topk,
    toxicity,
    vector_codes,
)

MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_spans(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["label"].isin([t.label for t in licenses.BASE]))

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda s: s["first"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
    )


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece.encode_digests(table(spark, folder, "documents"), public_tokenizers.path(MODEL))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    length = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    items = F.array_sort(F.transform("found.items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        length.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (length > 0).alias("contaminated"),
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fold = lambda c: F.crc32(c.cast("string")) % 3
    model = toxicity.fit(docs, table(spark, folder, "labels"), fold(F.col("doc_id")) != 1)
    return toxicity.score(docs, model).select(
        "doc_id",
        (fold(F.col("doc_id")) == 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.REJECT).cast("int").alias("predicted"),
    )


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.fit(docs, F.coalesce(~held_out, F.lit(False)))
    return language.predict(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"),
    )


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs)).select(
        "doc_id",
        F.col("quality.score").alias("score"),
        F.col("quality.weak_label").alias("weak_label"),
        (F.col("quality.score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, vectors.where("id % 20 = 0"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(table(spark, folder, "documents"))


def prefix_trie_nodes(conversations: DataFrame) -> DataFrame:
    """The trie of conversations that share the openings of the first of their hundred."""
    return prefix_trie.build_trie(prefix_trie.shared_openings(prefix_trie.turn_sequences(conversations)))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie_nodes(table(spark, folder, "conversations"))


def op12_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def vector_code_rows(vectors: DataFrame) -> DataFrame:
    """Codes, errors and the digest of the codebooks, for every row with a finite vector."""
    kept = vector_codes.kept_vectors(vectors)
    books = vector_codes.fit(kept)
    coded = vector_codes.with_label_error(vector_codes.encode(kept, books))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_code_rows(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_sentencepiece,
        op3_line_dedup,
        op4_jaccard_join,
        op5_decontaminate,
        op6_toxicity,
        op7_language_id,
        op8_quality,
        op9_exact_top_k,
        op10_sharding,
        op11_prefix_trie,
        op12_html_text,
        op13_vector_codes,
    )
}
