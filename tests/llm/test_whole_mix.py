"""Equal rows in a mix: each gets its share, whatever their number."""

import collections

import hard
from pyspark.sql import functions as F

from collatio.llm import mixing


def test_many_equal_rows(spark):
    rows = [(None, "a b c d e", "en", "hot")] * 700 + [(5, "x y", "en", "hot")] * 90 + [(i, f"w{i} v", "en", "cold") for i in range(10)] + [(None, None, "en", "hot")] * 5
    docs = hard.documents(spark, rows).repartition(5)
    out = mixing.mixed_documents(docs, weights=(1, 30))
    plan = mixing.mix(docs, weights=(1, 30)).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    got = collections.Counter()
    for r in out.collect():
        got[r.source] += len((r.text or "").split())
        assert r.text is None or len(r.text) == r.n_chars
    assert {r.source: r.taken for r in plan} == dict(got) and all(r.taken == int(r.target) for r in plan)
    shapes = collections.Counter(r.text for r in out.where("source = 'hot'").collect())
    assert sum(n for t, n in shapes.items() if t not in ("a b c d e", "x y", None)) <= 1


def test_odd_columns(spark):
    docs = hard.clashing(hard.documents(spark)).withColumn("n", F.lit(1)).withColumn("size", F.lit("s")).withColumn("whole_epochs", F.lit("w"))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and {r["size"] for r in out.select("size").collect()} == {"s"}
