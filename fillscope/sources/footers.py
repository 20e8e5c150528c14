"""What Parquet footers know, read by the executors: schemas, row groups, rows, ranges, first rows.

The file list is a DataFrame, and each task opens the files of its own rows. A footer says everything but
the preview, so no data pages are read, and the number of Spark jobs does not depend on the number
of files. Files of a store that only Spark can open come as the binary source's content instead.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

# Stores that executors open by range; of any other, Spark reads whole files.
DIRECT_SCHEMES = ("file", "hdfs")
# Spark's names of Arrow's plain types (fixed values).
PLAIN_TYPES = {
    "bool": "boolean",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "float": "float",
    "double": "double",
    "string": "string",
    "large_string": "string",
    "binary": "binary",
    "large_binary": "binary",
    "date32[day]": "date",
}


def spark_type(kind: pa.DataType) -> str:
    """An Arrow type under Spark's name, or as it is where Spark has none."""
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_map(kind):
        return f"map<{spark_type(kind.key_type)},{spark_type(kind.item_type)}>"
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return f"array<{spark_type(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return f"struct<{','.join(f'{field.name}:{spark_type(field.type)}' for field in kind)}>"
    return PLAIN_TYPES.get(str(kind), str(kind))


def _opened(path: str, content: bytes | None) -> pq.ParquetFile:
    if content is not None:
        return pq.ParquetFile(pa.BufferReader(content))
    if path.startswith("file:"):
        return pq.ParquetFile(pafs.LocalFileSystem().open_input_file(re.sub("^file:/+", "/", path)))
    store, inside = pafs.FileSystem.from_uri(path)
    return pq.ParquetFile(store.open_input_file(inside))


def data_files(spark: SparkSession, root: str) -> DataFrame:
    """Parquet files below ``root``: path and length, and the content only where it is needed to open them."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(root)
    )
    scheme = root.split("://", 1)[0] if "://" in root else "file" if root.startswith("file:") else ""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").split(":", 1)[0]
    direct = (scheme or default) in DIRECT_SCHEMES
    return files.select("path", "length", *([] if direct else ["content"]))


def _per_file(files: DataFrame, rows_of: Callable[[pq.ParquetFile], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows made from each opened file, after its path."""
    names = [part.split(" ")[0] for part in schema.split(", ")]
    kinds = [pa.string() if part.endswith(" string") else pa.int64() for part in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column("content") if "content" in batch.schema.names else None
            for at, path in enumerate(batch.column("path").to_pylist()):
                with _opened(path, contents[at].as_py() if contents is not None else None) as opened:
                    rows = [(path, *row) for row in rows_of(opened)]
                if rows:
                    yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)

    return files.mapInArrow(read, schema)


def file_footers(files: DataFrame) -> DataFrame:
    """One row per file: rows, row groups, columns, and the schema as text."""

    def rows(opened: pq.ParquetFile) -> Iterator[tuple]:
        schema = opened.schema_arrow
        text = ", ".join(f"{field.name} {spark_type(field.type)}" for field in schema)
        yield opened.metadata.num_rows, opened.metadata.num_row_groups, len(schema), text

    return _per_file(files, rows, "path string, total_rows bigint, row_groups bigint, n_columns bigint, schema string")


def _text(value) -> str | None:
    if value is None:
        return None
    return value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)


def column_ranges(files: DataFrame) -> DataFrame:
    """One row per file and flat column: nulls, smallest and largest value as text, from the row groups' statistics.

    A file's number is NULL where a row group has no statistics for it. Long texts may be cut by the writer.
    """

    def rows(opened: pq.ParquetFile) -> Iterator[tuple]:
        found = opened.metadata
        for column in range(found.num_columns):
            groups = [found.row_group(g).column(column) for g in range(found.num_row_groups)]
            stats = [g.statistics for g in groups if g.num_values]
            whole = bool(stats) and all(s is not None for s in stats)
            nulls = sum(s.null_count for s in stats) if whole and all(s.has_null_count for s in stats) else None
            ranged = [s for s in stats if s is not None and (s.has_min_max or s.null_count != s.num_values + s.null_count)]
            known = whole and bool(ranged) and all(s.has_min_max for s in ranged)
            name = found.schema.column(column).path
            low, high = (min(s.min for s in ranged), max(s.max for s in ranged)) if known else (None, None)
            yield name, found.num_rows, nulls, _text(low), _text(high)

    return _per_file(
        files, rows, "path string, column_name string, total_rows bigint, n_nulls bigint, min_value string, max_value string"
    )


def first_rows(files: DataFrame, count: int = 5) -> DataFrame:
    """The first rows of each file as JSON objects, with their zero-based position.

    One small batch of the first row group is decoded per file.
    """

    def rows(opened: pq.ParquetFile) -> Iterator[tuple]:
        seen = 0
        for batch in opened.iter_batches(batch_size=count):
            for row in batch.to_pylist():
                if seen == count:
                    return
                yield seen, json.dumps(row, default=str, ensure_ascii=False)
                seen += 1
            if seen == count:
                return

    return _per_file(files, rows, "path string, position bigint, row_json string")
