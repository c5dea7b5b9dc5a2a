"""The kernel's Arrow functions under names that SQL can use; the others are expressions of built-in ones."""

from __future__ import annotations

from pyspark.sql import SparkSession

from collatio.functions import kernel
from collatio.operators.equations import unescaped

FUNCTIONS = {"repair_accents": kernel.composed, "nfkc": kernel.compatible, "indel_ratio": kernel.indel_ratio, "unescape_html": unescaped}


def register(spark: SparkSession) -> None:
    for name, f in FUNCTIONS.items():
        spark.udf.register(name, f)
