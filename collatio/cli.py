"""Command line: list the registered queries, run one, check chapters of a corpus of two renderings."""

from __future__ import annotations

import argparse
import importlib.metadata
import platform
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.functions import kernel
from collatio.operators import gates, multiset
from collatio.plans.catalog import QUERIES


def selected(df: DataFrame, chapters: list[int] | None, column: str = "chapter") -> DataFrame:
    """The rows of the named chapters, or all."""
    return df if not chapters else df.where(F.col(column).isin(chapters))


def versions(spark: SparkSession) -> DataFrame:
    """One row with the versions that a run used."""
    found = {"python": platform.python_version(), "spark": spark.version} | {p: importlib.metadata.version(p) for p in ("pyarrow", "pandas", "numpy")}
    return spark.createDataFrame([found])


def verify(reference: DataFrame, candidate: DataFrame, chapters: list[int] | None) -> DataFrame:
    """The coverage and number gates of two tables (chapter, text)."""
    ref, cand = (selected(d.select("chapter", "text"), chapters) for d in (reference, candidate))
    bags = lambda what: [multiset.bag(d, what(F.col("text")), ["chapter"]) for d in (ref, cand)]
    return gates.text_coverage(*bags(kernel.tokens), ["chapter"]).unionByName(gates.numeric_fidelity(*bags(kernel.numbers), ["chapter"]))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="collatio", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="names of the registered queries")
    run = sub.add_parser("run", help="run a query and write its rows")
    run.add_argument("name", choices=sorted(QUERIES))
    run.add_argument("tables")
    run.add_argument("out")
    check = sub.add_parser("verify", help="compare two Parquet tables (chapter, text)")
    check.add_argument("reference")
    check.add_argument("candidate")
    check.add_argument("out")
    which = check.add_mutually_exclusive_group()
    which.add_argument("--chapter", type=int, nargs="+")
    which.add_argument("--all", action="store_true")
    sub.add_parser("versions", help="versions in use")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = SparkSession.builder.appName("collatio").getOrCreate()
    if args.command == "versions":
        versions(spark).show(truncate=False)
    elif args.command == "run":
        QUERIES[args.name](spark, args.tables).write.mode("overwrite").parquet(args.out)
    else:
        verify(spark.read.parquet(args.reference), spark.read.parquet(args.candidate), args.chapter).write.mode("overwrite").parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
