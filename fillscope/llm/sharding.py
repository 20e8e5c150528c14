"""Sharding by extendible hashing.

A document belongs to the bucket named by the first bits of its hash. The directory starts with
no bits; a bucket that holds more bytes than a shard may is split by one more bit, until
every bucket fits. Only the sums of bytes per hash prefix are looked at, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillscope.scale import cut_lineage

SHARD_BYTES = 64 << 20
HASH_BITS = 60
# Bits looked at in one round of splits.
ROUND_BITS = 12


def hash_bits(key: Column, text: Column) -> Column:
    """A 60-bit hash of a document's key and text."""
    name = F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def _prefix(h: Column, depth: Column) -> Column:
    """The first ``depth`` of the hash's bits as a number."""
    return F.call_function("shiftright", h, (F.lit(HASH_BITS) - depth).cast("int"))


def assign_shards(
    docs: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: key, n_bytes, shard, shard_depth, shard_bytes, fits.

    n_bytes: UTF-8 bytes of the text, 0 for null. shard: the bits of the bucket's hash prefix, an empty string
    if all documents fit into one. fits is false only for a bucket that no
    more bits can split: one document larger than the limit, or equal rows (same key and text) that are
    together. Null keys and repeated rows are documents like others.
    """
    placed = _placed(docs, limit, key, text)
    bits = F.lpad(F.conv(F.col("_at.prefix").cast("string"), 10, 2), HASH_BITS, "0")
    depth = F.col("_at.depth")
    return placed.select(
        docs[key],
        F.col("_bytes").alias("n_bytes"),
        F.when(depth == 0, "").otherwise(F.substring(bits, F.lit(HASH_BITS + 1) - depth, depth)).alias("shard"),
        depth.cast("long").alias("shard_depth"),
        F.col("_shard_bytes").alias("shard_bytes"),
        (F.col("_shard_bytes") <= limit).alias("fits"),
    )


def _placed(docs: DataFrame, limit: int, key: str, text: str) -> DataFrame:
    """All rows and columns of ``docs`` with _bytes, _at (depth, prefix) and _shard_bytes."""
    body = docs[text].cast("string")
    sized = docs.withColumns({"_hash": hash_bits(docs[key], body), "_bytes": F.coalesce(F.octet_length(body), F.lit(0)).cast("long")})
    directory = cut_lineage(_directory(sized.select(F.col("_hash").alias("hash"), F.col("_bytes").alias("n_bytes")), limit))
    # Each bucket of the directory is looked up by the hash prefix of its own depth.
    depths = [r["depth"] for r in directory.select("depth").distinct().orderBy("depth").collect()] or [0]
    places = [F.struct(F.lit(d).alias("depth"), _prefix(F.col("_hash"), F.lit(d)).alias("prefix")) for d in depths]
    buckets = directory.select(F.struct("depth", "prefix").alias("_bucket"), F.col("bytes").alias("_shard_bytes"))
    return (
        sized.withColumn("_at", F.explode(F.array(*places)))
        .join(buckets, F.col("_at") == F.col("_bucket"))
        .drop("_hash", "_bucket")
    )


def _directory(rows: DataFrame, limit: int) -> DataFrame:
    """Buckets (depth, prefix, bytes) that cover all documents."""
    done = None
    open_rows, depth = rows.select("hash", "n_bytes"), 0
    while True:
        last = min(depth + ROUND_BITS, HASH_BITS)
        cells = cut_lineage(
            open_rows.groupBy(_prefix(F.col("hash"), F.lit(last)).alias("cell"))
            .agg(F.sum("n_bytes").alias("bytes"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        )
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(depth), F.lit(last)))).withColumn(
            "prefix", F.call_function("shiftright", "cell", (F.lit(last) - F.col("depth")).cast("int"))
        )
        sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
        # A bucket stays whole if it fits, or if one hash makes it.
        final = sums.where((F.col("bytes") <= limit) | (F.col("low") == F.col("high")))
        # The least depth at which a cell's bucket is final is where its splits end.
        chosen = (
            levels.select("cell", "depth", "prefix")
            .join(final.select("depth", "prefix", F.col("bytes").alias("total")), ["depth", "prefix"])
            .groupBy("cell")
            .agg(F.min(F.struct("depth", "prefix", F.col("total").alias("bytes"))).alias("best"))
        )
        buckets = chosen.select("best.depth", "best.prefix", "best.bytes").distinct()
        done = buckets if done is None else done.union(buckets)
        if last == HASH_BITS:
            return done
        left = cut_lineage(cells.join(chosen, "cell", "left_anti").select("cell"))
        if left.isEmpty():
            return done
        open_rows = open_rows.withColumn("cell", _prefix(F.col("hash"), F.lit(last))).join(left, "cell", "left_semi").select("hash", "n_bytes")
        depth = last + 1


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> None:
    """Write the documents below ``path``, one folder ``shard=depth-prefix`` for each shard.

    Rows are placed by the directory on their hash, so that a folder is written by one task.
    """
    placed = _placed(docs, limit, key, text)
    name = F.format_string("%d-%d", F.col("_at.depth"), F.col("_at.prefix"))
    named = placed.withColumn("shard", name).drop("_at", "_bytes", "_shard_bytes")
    named.repartition("shard").write.partitionBy("shard").parquet(path)
