"""Leaving out rows before a shuffle whose ids the other side of a join can't hold.

A filter holds the other side's ids in 16 bits for each, `LEAST` bits at least and `MOST` at most, so it
is of bounded size; rows are kept if all their bits are set. It never drops a row that joins. With far
more ids than bits it keeps everything, and the join does what it would have done without it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collatio.llm.words import mix

LEAST, MOST = 1 << 20, 1 << 28


def _positions(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    return (h & np.uint64(bits - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)


def bits_of(ids: DataFrame) -> bytes:
    """The filter of one bigint column; null ids are in no filter."""
    bits = min(MOST, max(LEAST, 1 << (16 * ids.count()).bit_length()))

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(np.concatenate(_positions(np.asarray(b.column(0).drop_null()), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)).view(np.int64))], names=["word", "mask"])

    # At most MOST / 64 rows come to the driver, whatever the input.
    words = ids.mapInArrow(marks, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[np.asarray(words.column("word"))] = np.asarray(words.column("mask"))
    return table.tobytes()


def maybe(table: bytes, ids: np.ndarray) -> np.ndarray:
    """Which ids the filter may hold."""
    t = np.frombuffer(table, np.int64)
    x, y = _positions(ids, 64 * len(t))
    return ((t[x >> 6] >> (x & 63)) & (t[y >> 6] >> (y & 63)) & 1).astype(bool)


def parted(rows: DataFrame, id_column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of `rows` whose id may be in `ids` (one bigint column), and the others, null ids among these."""
    held = rows.sparkSession.sparkContext.broadcast(bits_of(ids))

    def test(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                c = b.column(id_column)
                ok = maybe(held.value, np.asarray(pc.fill_null(c, 0))) & ~np.asarray(c.is_null().to_numpy(zero_copy_only=False))
                yield b.filter(pa.array(ok == wanted))

        return run

    return rows.mapInArrow(test(True), rows.schema), rows.mapInArrow(test(False), rows.schema)


def possible(rows: DataFrame, id_column: str, ids: DataFrame) -> DataFrame:
    """The rows of `rows` whose id may be in `ids`."""
    return parted(rows, id_column, ids)[0]
