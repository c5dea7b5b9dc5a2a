"""Queries over lines and words of documents, with line ends that join words or citations, against their twins in SQL."""

import duckdb
import pandas as pd
import pytest

from collatio.plans.catalog import ORACLES, QUERIES
from test_oracles import TABLES, rows

TEXTS = [
    "a head\nthe same line 12\nbroken com-\nputer 3.50 here 1st\nother foot\n\n7",
    "a head\nthe same line 12\nputer com and more [1,\n2] 4 5\nthe same line 12\nother foot\n\n8",
    "x head\nthe same line 12\ncom-\n  puter puter .5 0.50\nother foot\n\niv",
    "the same line 12\nsoft hy­\nphen “quoted” 9.10 2–\n3\nother foot\n1 2 3 4 5 6 7\n",
    "1 2 3 4 5 6 9 10\nthe same line 12\nthe same line 12\n",
    "", None, "\n\n", "1 1 1 1 2 3", "no more com-\nthe same line 12\ncomthe 12", "Été x\nother foot\n[3] see 12", "3 four five six\nother foot\n",
]
NAMES = ["text_coverage", "coverage_by_language", "numeric_fidelity", "numeric_by_language", "coverage_details", "review_rows", "review_queue", "gate_status_rollup", "progress_status", "removed_by_reason", "line_furniture_reason", "token_bag_top"]


@pytest.fixture(scope="module")
def lines_dir(tmp_path_factory, sf_dir):
    d = tmp_path_factory.mktemp("lines")
    for t in TABLES:
        duckdb.sql(f"COPY (SELECT * FROM '{sf_dir}/{t}.parquet') TO '{d}/{t}.parquet'")
    docs = pd.DataFrame({"doc_id": range(1, len(TEXTS) + 1), "text": TEXTS, "lang": ["en", "fr", "de"] * (len(TEXTS) // 3), "source": "s"})
    duckdb.sql(f"COPY (SELECT doc_id, text, lang, source, len(text) AS n_chars FROM docs) TO '{d}/documents.parquet'")
    return str(d)


def test_counts_are_those_of_the_items(spark):
    """Counts come from the raw line, so characters that normalisation changes must not change them."""
    from pyspark.sql import functions as F

    from collatio.functions import kernel

    odd = [*(t for t in TEXTS if t), "\u0130x \u0130", "e\ufb03x 3\u2013x\u00ad4", "\u00bd \u0665th 5TH \u2160a", "a_b 1.5.2 .7st", " \u00a0 "]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    t = F.col("t")
    assert df.where((kernel.n_tokens(t) != F.size(kernel.tokens(t))) | (kernel.n_numbers(t) != F.size(kernel.numbers(t)))).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_joined_lines(name, spark, lines_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{lines_dir}/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, lines_dir).toPandas(), con.sql(ORACLES[name]).df()
    assert rows(ours) == rows(theirs) and len(ours)
