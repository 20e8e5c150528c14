"""Catalogue registration, introspection and dataset profiling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillscope.scale import row_at, shared_folder
from fillscope.sources.footers import column_ranges, data_files, file_footers, first_rows
from fillscope.sources.sinks import write_parquet

# Folders the profile leaves out.
SKIPPED_FOLDERS = ("blocks", "legacy_trades")


def store(df: DataFrame, path: str | None = None, purpose: str = "table") -> DataFrame:
    """Materialize a query as parquet and continue from the stored rows."""
    spark = df.sparkSession
    target = path or shared_folder(spark, purpose)
    write_parquet(df, target)
    return spark.read.schema(df.schema).parquet(target)


def register_warehouse(
    spark: SparkSession, markets: DataFrame, trade_files: str, prefix: str = "warehouse", path: str | None = None
) -> list[str]:
    """Markets as a stored table, trades as a permanent view over their files, which copies nothing.

    Both belong to the session catalogue, so that other sessions, and with a metastore later runs, find them
    with their definitions. Objects of these names are replaced, whichever kind they are.
    """
    names = [f"{prefix}_markets", f"{prefix}_trades"]
    for name in names:
        drop_object(spark, name)
    target = path or shared_folder(spark, names[0])
    markets.write.mode("overwrite").option("path", target).saveAsTable(names[0])
    spark.sql(f"CREATE VIEW {names[1]} AS SELECT * FROM parquet.`{trade_files}`")
    return names


def drop_object(spark: SparkSession, name: str) -> None:
    """Remove a table or a view; its files stay, unless the catalogue manages them."""
    if spark.catalog.tableExists(name):
        kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {name}")


def definition(spark: SparkSession, name: str) -> dict[str, str | None]:
    """Type, columns and definition of an object, as the catalogue stores them.

    The definition is a view's query, and a table's CREATE statement; temporary views have none.
    """
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    cut = next((i for i, r in enumerate(rows) if not r.col_name or r.col_name.startswith("#")), len(rows))
    details = {r.col_name: r.data_type for r in rows[cut:]}
    is_view = details.get("Type") == "VIEW" or spark.catalog.getTable(name).isTemporary
    return {
        "object_type": "VIEW" if is_view else "TABLE",
        "columns": ", ".join(f"{r.col_name} {r.data_type}" for r in rows[:cut]),
        "definition": details.get("View Text") if is_view else spark.sql(f"SHOW CREATE TABLE {name}").first()[0],
    }


def describe_objects(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """One row per name: whether it exists, what it is, its columns, definition and row count."""

    def one(name: str) -> DataFrame:
        found = definition(spark, name) if spark.catalog.tableExists(name) else {}
        if found:
            counted = spark.table(name).agg(F.count(F.lit(1)).alias("row_count"))
        else:
            counted = spark.range(1).select(F.lit(None).cast("long").alias("row_count"))
        text = {key: F.lit(found.get(key)).cast("string").alias(key) for key in ("object_type", "columns", "definition")}
        width = len(spark.table(name).columns) if found else 0
        return counted.select(
            F.lit(name).alias("object_name"),
            text["object_type"],
            F.lit(width).cast("long").alias("n_columns"),
            "row_count",
            text["columns"],
            text["definition"],
        )

    return reduce(DataFrame.unionByName, map(one, names))


def table_columns(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns


def list_data_files(
    spark: SparkSession,
    root: str,
    max_files: int | None = None,
    skipped: Iterable[str] = SKIPPED_FOLDERS,
) -> DataFrame:
    """Parquet files below ``root``; with ``max_files``, only the first of each folder by name."""
    parts = F.split("path", "/")
    files = data_files(spark, root).select(
        "*",
        F.element_at(parts, -1).alias("file_name"),
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/").alias("folder"),
    )
    files = files.filter(
        ~F.arrays_overlap(F.split("folder", "/"), F.array(*[F.lit(name) for name in skipped]))
    )
    if max_files is None:
        return files
    by_name = W.partitionBy("folder").orderBy("file_name")
    return files.withColumn("rank", F.row_number().over(by_name)).filter(
        F.col("rank") <= max_files
    ).drop("rank")


def _placed(found: DataFrame, root: str) -> DataFrame:
    """Replace the path by folder and file name, and by the folder's place below ``root``."""
    plain = _plain_path(F.col("path"))
    parts = F.split(plain, "/")
    folder = F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/")
    top = F.rtrim(_plain_path(F.lit(root)), F.lit("/"))
    below = F.when(folder.startswith(F.concat(top, F.lit("/"))), F.substr(folder, F.length(top) + 2)).otherwise(F.lit("."))
    return found.select(
        folder.alias("folder"),
        below.alias("below_root"),
        F.element_at(parts, -1).alias("file_name"),
        *[c for c in found.columns if c != "path"],
    )


def profile_dataset(
    spark: SparkSession,
    root: str,
    max_files: int | None = None,
    skipped: Iterable[str] = SKIPPED_FOLDERS,
) -> DataFrame:
    """Per folder and file: rows, row groups, column count, and column names with types.

    Files without rows are listed with 0, an empty tree gives no rows. Footers are read by the executors (see
    ``footers``); nothing comes to the driver.
    """
    return _placed(file_footers(list_data_files(spark, root, max_files, skipped)), root)


def profile_columns(
    spark: SparkSession, root: str, max_files: int | None = None, skipped: Iterable[str] = SKIPPED_FOLDERS
) -> DataFrame:
    """Per file and column: rows, nulls and range from the footer's statistics."""
    return _placed(column_ranges(list_data_files(spark, root, max_files, skipped)), root)


def preview_files(
    spark: SparkSession,
    root: str,
    rows: int = 5,
    max_files: int | None = None,
    skipped: Iterable[str] = SKIPPED_FOLDERS,
) -> DataFrame:
    """The first rows of each file as JSON."""
    return _placed(first_rows(list_data_files(spark, root, max_files, skipped), rows), root)


def _plain_path(path: Column) -> Column:
    """A path without the scheme of local files, whose spelling varies."""
    return F.regexp_replace(path, "^file:/+", "/")


def preview(spark: SparkSession, path: str, rows: int = 5) -> DataFrame:
    """The first rows of one file."""
    return spark.read.parquet(path).limit(rows)


def nth_row(df: DataFrame, position: int, order: Sequence[str]) -> DataFrame:
    """The row at a zero-based position of a declared order."""
    return row_at(df, position, order)
