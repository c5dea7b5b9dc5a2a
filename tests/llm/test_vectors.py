"""Exact top-k search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from collatio.llm import topk

SCHEMA = "id long, vector array<double>"


def brute(rows, queries, k, scale):
    ok = [(i, [int(scale) * int(x) if abs(x) > 2**53 else int(np.floor(scale * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q in sorted({i for i, _ in ok if i in queries}):
        mine = min(v for i, v in ok if i == q)
        best = sorted((-min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(mine, v)))), i) for i, v in ok if i != q)[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize(("block", "cell"), [(8, 4), (2048, 16), (2048, 256)])
def test_search(block, cell, spark, monkeypatch):
    rs = np.random.RandomState(0)
    rows = [(i, (rs.randn(6) * rs.choice([0.1, 1, 5])).tolist()) for i in range(150)] + [(200 + i, [1.0] * 6) for i in range(40)]
    rows += [(350, [1e300] * 6), (400, [1.7e308, -1.7e308] + [0.0] * 4), (401, [-1e300] * 6), (402, [2.0**50, 1.0] + [0.0] * 4), (None, [1.0] * 6), (300, None), (301, [1.0, None] + [0.0] * 4), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5), (304, [0.0] * 6), (0, rows[0][1])]
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "CELL", cell)
    monkeypatch.setattr(topk, "FIRST", 4)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("cell", F.lit("x"))
    v = df.select("id", "vector")
    ids = {i for i, _ in rows if i is not None and i % 50 == 0}
    got = topk.Index.build(v, 256.0).search(v.where("id % 50 = 0"), 5).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(r) for r in got} == brute(rows, ids, 5, 256.0)


def test_few_and_none(spark):
    v = spark.createDataFrame([(0, [1.0]), (50, [2.0]), (7, [-1.0])], SCHEMA)
    got = {(r.query_id, r.rank, r.id, r.score) for r in topk.Index.build(v, 256.0).search(v.where("id % 50 = 0"), 5).collect()}
    assert got == {(0, 1, 50, 131072), (0, 2, 7, -65536), (50, 1, 0, 131072), (50, 2, 7, -131072)}
    assert topk.Index.build(v.where("false")).search(v.where("false"), 5).count() == 0


def test_large_components(spark):
    v = spark.createDataFrame([(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 1.0])], SCHEMA)
    got = [(r.id, r.score) for r in topk.Index.build(v, 256.0).search(v.where("id = 0"), 2).orderBy("rank").collect()]
    assert got == [(1, 768000000**2 + 256 * 512), (2, 768000000**2 + 256 * 256)]


def test_clusters_are_passed_over(spark, monkeypatch):
    """Where vectors lie in clusters, most cells are ruled out."""
    rs = np.random.RandomState(1)
    monkeypatch.setattr(topk, "CELL", 16)
    monkeypatch.setattr(topk, "FIRST", 16)
    centres = rs.randn(30, 8) * 5
    rows = [(i, (centres[i % 30] + 0.05 * rs.randn(8)).tolist()) for i in range(1500)]
    v = spark.createDataFrame(rows, SCHEMA)
    index = topk.Index.build(v, 256.0)
    got = {tuple(r) for r in index.search(v.where("id % 50 = 0"), 5).collect()}
    assert got == brute(rows, set(range(0, 1500, 50)), 5, 256.0)
    some, all_ = index.compared()
    assert some < all_ / 2
