"""Sinks. Every one writes from the executors and replaces the target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("delimiter", delimiter).option(
        "escape", '"'
    ).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    """Drop and recreate a managed table from a query."""
    df.write.mode("overwrite").saveAsTable(name)


def write_report(report: DataFrame, path: str, cluster: str = "cluster") -> None:
    """A cluster report as text lines, one per cluster and feature, in cluster order."""
    line = F.format_string(
        "cluster %s | %s: mean=%.4f, median=%.4f, global=%.4f, diff=%+.4f, %+.1f%%",
        F.col(cluster).cast("string"),
        "feature",
        "mean",
        "median",
        "global_mean",
        "diff",
        "diff_pct",
    )
    report.orderBy(cluster, "feature").select(line.alias("value")).write.mode("overwrite").text(path)
