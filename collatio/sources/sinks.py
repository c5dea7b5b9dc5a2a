"""Sinks: tables by chapter that a rerun replaces chapter by chapter, append-only logs, Markdown files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_chapters(df: DataFrame, path: str, by: tuple[str, ...] = ("book_id", "chapter")) -> None:
    """Replaces the partitions that `df` has rows of and leaves the others."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_verdicts(df: DataFrame, path: str) -> None:
    df.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(path)


def write_new(df: DataFrame, path: str, force: bool = False) -> None:
    """Fails where there is something already, unless forced."""
    df.write.mode("overwrite" if force else "errorifexists").parquet(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Markdown of pages (path, markdown) as text, one folder for each page's path."""
    pages.select(F.col("path").alias("page"), "markdown").repartition("page").write.mode("overwrite").partitionBy("page").option("lineSep", "\n").text(path)


def read_back(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
