"""Queries that SQL cannot express, against the library and held-out labels."""

from __future__ import annotations

import brute
import public_tokenizers
import sentencepiece as library
from brute import ordered
from pyspark.sql import functions as F

from fillscope.llm.queries import MODEL, QUERIES
from fillscope.llm.sql_checks import SQL


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(SQL) <= set(QUERIES)


def test_sentencepiece(spark, folder):
    other = library.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc, text in docs:
        ids = other.encode(text)
        expected.append((doc, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(other.decode(ids))))
    found = QUERIES["op2_sentencepiece"](spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert ordered(found.collect()) == ordered(expected)


def test_toxicity_held_out(spark, folder):
    path = folder.replace("0.001", "0.01")
    found = QUERIES["op6_toxicity"](spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert found.count() == docs.count()
    known = found.join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = sorted(r.score for r in known if r.toxic == 1)
    plain = sorted(r.score for r in known if r.toxic == 0)
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in plain) / (len(toxic) * len(plain))
    assert wins >= 0.7
    assert sum(b >= 0.7 for b in plain) <= 0.02 * len(plain)


def test_classifier_queries_return_every_document(spark, folder):
    count = spark.read.parquet(f"{folder}/documents.parquet").count()
    for name in ("op6_toxicity", "op7_language_id", "op8_quality"):
        found = QUERIES[name](spark, folder)
        assert found.count() == count and found.where(~F.col("score").between(0, 1)).count() == 0
