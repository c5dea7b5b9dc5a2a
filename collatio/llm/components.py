"""Connected components of a table of links, by rounds of large and small stars.

Each round first replaces the links of a partition by a forest with the same components, then
moves every node to the smallest neighbour; the number of rounds grows with the logarithm of the
longest path. Links stay on the executors; every round is written and read again. As soon as a round
leaves no more than `CONTRACT` links, which a task contracts at a time anyway, one task does the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collatio.llm.staging import staged

#: Links that a task contracts at a time.
CONTRACT = 500_000
SCHEMA = "u bigint, v bigint"


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node of the links u-v but the least of its component, the node and that least one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    label = np.arange(len(nodes))
    a, b = at[: len(u)], at[len(u) :]
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:  # jump to the roots
            up = new[new]
            if (up == new).all():
                break
            new = up
        new = new[label]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for b in batches:
        held.append((np.asarray(b.column(0)), np.asarray(b.column(1))))
        n += b.num_rows
        if n > CONTRACT:
            f = forest(*map(np.concatenate, zip(*held, strict=True)))
            if len(f[0]) > CONTRACT // 2:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in f], names=["u", "v"])
                f = (f[0][:0], f[1][:0])
            held, n = [f], len(f[0])
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in forest(*map(np.concatenate, zip(*held, strict=True)))], names=["u", "v"])


def _least(links: DataFrame) -> DataFrame:
    """(u, m): the least of each node and the nodes v that u has."""
    return links.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): of links (u, v), each node that isn't the least of its component, with that least node."""
    now = staged(links.select("u", "v").mapInArrow(_contract, SCHEMA), "stars")
    mark = None
    while now.count() > CONTRACT:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(now.where("false")).distinct().where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        now = staged(small.mapInArrow(_contract, SCHEMA).distinct(), "stars")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    else:
        now = now.coalesce(1).mapInArrow(_contract, SCHEMA)
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
