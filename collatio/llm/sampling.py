"""Bounded samples of labelled rows, drawn by a hash of their id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.llm.staging import staged

#: Rows are left out of all learning if the CRC-32 of their id as text has this remainder modulo 4.
HELD_OUT = 2


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


#: Tables of labels up to this many rows are broadcast; larger ones are joined by shuffling.
BROADCAST_ROWS = 10_000


def draw(rows: DataFrame, label: str, size: int, *key: str) -> DataFrame:
    """About `size` rows of each label at most, those with the smallest hashes of `key`, with the hash as `draw`.

    The number of a label's rows, which are counted first, gives the share of hashes to take. Rows with
    an equal key are taken together.
    """
    unit = F.shiftrightunsigned(F.xxhash64(F.lit("draw"), *key), 11).cast("double") / float(1 << 53)
    counts = staged(rows.groupBy(F.col(label).alias("__label")).agg(F.count("*").alias("__n")), "label-counts")
    # A broadcast leaves the rows where they are.
    few = F.broadcast(counts) if counts.count() <= BROADCAST_ROWS else counts
    return rows.join(few, F.col(label) == F.col("__label")).withColumn("draw", unit).where(F.col("draw") < F.lit(float(size)) / F.col("__n")).drop("__n", "__label")
