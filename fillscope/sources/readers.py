"""Loaders with declared schemas.

Spark itself skips files whose names start with ``.`` or ``_``, so a folder with
resource-fork debris reads cleanly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fillscope import schemas


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line. The schema is always declared: inference would turn
    256-bit asset ids into lossy numbers."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_markets(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.MARKETS)


def read_trades(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.TRADES)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.BLOCKS)


def read_trader_stats(spark: SparkSession, path: str) -> DataFrame:
    """Trader metrics from CSV, with or without a leading ``primary_category``."""
    names = spark.read.option("header", True).csv(path).columns
    schema = schemas.UPDATED_TRADER_STATS if "primary_category" in names else schemas.TRADER_STATS
    by_name = {field.name: field for field in schema.fields}
    schemas_in_file_order = T.StructType(
        [by_name.get(name, T.StructField(name, T.StringType(), True)) for name in names]
    )
    return read_csv(spark, path, schemas_in_file_order)
