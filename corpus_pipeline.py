"""From raw documents to packed sequences: quality rules, near-duplicates, personal data, the mix, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All stages but the last return the columns
of the documents that they were given, so each can be left out or run on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from collatio.llm import mixing, neardup, packing, pii, quality
from collatio.llm.queries import tokenizer_path
from collatio.llm.staging import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the rules of policy v1."""
    return quality.kept_documents(docs, "v1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of those whose 5-word shingles are similar by 0.8 or more."""
    return neardup.deduplicated(docs, k=5, percent=80)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with surrogates for personal data; n_chars, if there, follows the text."""
    return pii.replaced(docs, pii.session_key(spark)).select(*pii.fitting(docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated and cut as their sources' budgets say."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 ids."""
    return packing.packed(docs, tokenizer_path())


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("private data", private_data), ("mix", mix), ("packing", pack)]

#: Near-duplicates need signatures and packing a linear program: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
