"""The corpus pipeline: five stages over documents, each one operator.

A stage gets the documents its predecessor kept and returns documents with the same columns;
only the last returns tokens. Stages are written as Parquet and read again in between.
No stage can be expressed in SQL as a whole, so the tests compare with brute force.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillscope.llm import decontaminate, jaccard, lines, sentencepiece, toxicity
from fillscope.scale import cut_lineage

MODEL = "piece_bpe_32k.model"


def new_name(purpose: str) -> str:
    """A column name that no input has."""
    return f"{purpose}_{uuid.uuid4().hex}"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the limit. Labels of held-out documents teach nothing."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, F.crc32(labels["doc_id"].cast("string")) % 3 != 1)
    own = new_name("toxicity")
    return toxicity.score(docs, model, name=own).where(F.col(own) < toxicity.REJECT).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines they share with many; a document that loses all stays, empty."""
    # Columns that the operator would replace step aside.
    aside = {c: new_name(c) for c in docs.columns if c in ("n_lines", "n_dropped", "kept_text")}
    found = lines.dedup_lines(docs.withColumnsRenamed(aside))
    text = {"text": F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))}
    count = {"n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return found.withColumns(text).withColumns(count).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def row_names(docs: DataFrame, name: str) -> DataFrame:
    """Add a column that names each row, the same whenever the rows are read again.

    Rows of stored files are named by file and place; other rows are numbered and stored.
    """
    try:
        return docs.withColumn(name, F.struct("_metadata.file_path", "_metadata.row_index"))
    except AnalysisException:
        return cut_lineage(docs.withColumn(name, F.monotonically_increasing_id()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group; documents without words all stay.

    The row with the smallest id stays, rows without an id come last. Rows are told apart by their place,
    not by their id: unrelated rows that share an id or have none stay, repeated rows are a group.
    """
    own = new_name("row")
    named = row_names(docs, own)
    gone = jaccard.surplus_rows(named, own)
    return named.join(gone, own, "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    own = new_name("found")
    found = decontaminate.search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name=own)
    return found.where(F.size(F.col(own)["spans"]) == 0).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document: doc_id, n_tokens, ids, and the text they decode to."""
    found = sentencepiece.encode_documents(docs, public_tokenizers.path(MODEL))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = cut_lineage(docs)
    return docs
