"""Incremental checks: chapters that arrive are checked again as wholes.

A gate is an aggregate over a chapter, so a batch of new files recomputes the chapters it touches and
replaces their rows; there is no state between batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from collatio.sources.sinks import write_chapters


def on_arrival(spark: SparkSession, source: str, schema: str, check: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, by: tuple[str, ...] = ("book_id", "chapter")) -> StreamingQuery:
    """Runs `check` over every batch of new Parquet files under `source` and writes its rows by chapter; stops when none is left."""

    def batch(df: DataFrame, _: int) -> None:
        write_chapters(check(df), sink, by)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def not_done(new: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("book_id", "chapter", "source")) -> DataFrame:
    """Rows of chapters that no earlier run has written."""
    return new.join(done.select(*keys).distinct(), list(keys), "left_anti")
