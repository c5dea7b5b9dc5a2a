"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a temporary folder only where driver and executors are one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    global _local
    _local = _local or tempfile.mkdtemp(prefix="collatio-")
    return f"file://{_local}"


_local: str | None = None


#: Staged folders of this process; results may be lazy, so they stay until it ends.
_written: list[tuple[SparkSession, str]] = []


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _sweep() -> None:
    for spark, path in _written:
        with contextlib.suppress(Exception):
            removed(spark, path)


def swept(spark: SparkSession, path: str) -> str:
    """The path, which is deleted when the process ends."""
    _written.append((spark, path))
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet and read again: later steps start from these files, also after losing executors."""
    spark = df.sparkSession
    path = swept(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Holds the session's Arrow batches to `size` bytes: rows may be long texts, and workers hold copies of a batch."""
    unit = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(name)).lower()
    digits = now.rstrip("bkmg")
    if int(digits) <= 0 or int(digits) * unit.get(now[len(digits) : len(digits) + 1], 1) > size:
        spark.conf.set(name, f"{size}b")
