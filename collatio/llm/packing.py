"""Packing token sequences by cutting-stock column generation.

Each document's ids are cut into pieces of `LENGTH`, the rest of a document being a shorter piece.
The histogram of piece lengths, in classes of `QUANTUM` ids, is all that comes to the driver: at most
LENGTH / QUANTUM numbers. A linear program over patterns (how many pieces of each class share a
sequence) is solved by the revised simplex method; a knapsack by dynamic programming over the duals
prices new patterns. Patterns are used as often as the rounded-down solution says, and the few pieces
left, fewer than the patterns' own, go best fit, longest first. Pieces are then ranked within their
class and a piece's rank says its pattern, sequence and slot.

Null texts are empty: one piece with the end id alone. Repeated rows are documents of their own.
Long texts are tokenised whole, word by word: the tokenizer never joins what white space parts.
An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collatio.llm.staging import small_batches, staged
from collatio.llm.words import Words, alike, chunks

LENGTH = 2048
QUANTUM = 4
END = 1
#: Words that a worker remembers the ids of.
REMEMBERED = 1_000_000
#: Bytes of text that a worker tokenises at a time; in larger chunks more words are repeated.
CHUNK = 2_000_000
ROWS_PER_RANGE = 64
MAX_RANGES = 4096

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class Encoder:
    """Ids of the words of a chunk; each distinct word is tokenised once while it is remembered."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def ids(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all documents, END after each, and the offsets of the documents."""
        one, two = w.hashes()
        keys = alike(one, two)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        check = two[first]
        at = np.searchsorted(self.hashes, distinct)
        near = np.minimum(at, max(0, len(self.hashes) - 1))
        # Keys of this chunk alone, or another word with a remembered one's first hash: nothing may be remembered.
        odd = keys is not one or (len(self.hashes) and ((self.hashes[near] == distinct) & (self.checks[near] != check)).any())
        if odd or len(self.hashes) > REMEMBERED:
            self._forget()
            at = np.zeros(len(distinct), np.int64)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            data = w.data.tobytes()
            words = [data[s:e].decode() for s, e in zip(w.start[first[new]].tolist(), w.end[first[new]].tolist(), strict=True)]
            found = [e.ids for e in self._encode(words, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.array(list(itertools.chain.from_iterable(found)), np.uint32)
            starts = len(self.flat) + np.cumsum(sizes) - sizes
            self.hashes, self.checks = np.insert(self.hashes, at[new], distinct[new]), np.insert(self.checks, at[new], check[new])
            self.place = np.insert(self.place, at[new], len(self.sizes) + np.arange(len(new)))
            self.starts, self.sizes, self.flat = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, flat])
        which = self.place[np.searchsorted(self.hashes, distinct)][inverse]
        size = self.sizes[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        n = len(w.first) - 1
        offsets = ends[w.first] + np.arange(n + 1)
        out = np.full(int(offsets[-1]), END, np.uint32)
        target = np.arange(int(ends[-1])) + np.repeat(w.documents(), size)
        out[target] = self.flat[np.arange(int(ends[-1])) + np.repeat(self.starts[which] - ends[:-1], size)]
        if odd:
            self._forget()
        return out, offsets


@functools.cache
def _encoder(path: str) -> Encoder:
    """One for a worker's life, so that words are remembered from task to task."""
    return Encoder(path)


def _pieces(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for b in chunks(batches, limit=CHUNK):
            ids, offsets = encoder.ids(Words(b.column("text")))
            tokens = np.diff(offsets)
            parts = -(-tokens // length)
            doc = np.repeat(np.arange(len(tokens)), parts)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
            size = np.minimum(length, tokens[doc] - start)
            a = offsets[doc] + start
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(a.tolist(), (a + size).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(tokens[doc])], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity, as its value and counts."""
    good = np.flatnonzero((values > 1e-12) & (sizes <= capacity))
    counts = np.zeros(len(sizes), np.int64)
    if not len(good):
        return 0.0, counts
    order = good[np.argsort(sizes[good], kind="stable")]
    s, v = sizes[order], values[order]
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    fits = np.searchsorted(s, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room], pick[room] = best[room - 1], -1
        k = fits[room]
        if k:
            total = best[room - s[:k]] + v[:k]
            i = int(total.argmax())
            if total[i] > best[room]:
                best[room], pick[room] = total[i], i
    room = capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            counts[order[pick[room]]] += 1
            room -= int(s[pick[room]])
    return float(best[capacity]), counts


def fitted(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """The patterns of a best-fit packing, longest first, of all pieces of a class at a time, as columns."""
    bins: list[tuple[int, int, dict[int, int]]] = []  # (room, how many, pattern), by room
    for c in range(len(sizes) - 1, -1, -1):
        s, left = int(sizes[c]), int(demand[c])
        after: list[tuple[int, int, dict[int, int]]] = []
        for room, many, pattern in bins:
            each = room // s
            full = min(many, left // each) if each else 0
            if full:
                after.append((room - each * s, full, pattern | {c: each}))
                left -= full * each
                many -= full
            if each and many and left:
                after.append((room - left * s, 1, pattern | {c: left}))
                left, many = 0, many - 1
            if many:
                after.append((room, many, pattern))
        each = capacity // s
        if left // each:
            after.append((capacity - each * s, left // each, {c: each}))
        if left % each:
            after.append((capacity - left % each * s, 1, {c: left % each}))
        bins = sorted(after, key=lambda x: x[0])
    columns = np.zeros((len(sizes), len(bins)))
    for k, (_, _, pattern) in enumerate(bins):
        for c, n in pattern.items():
            columns[c, k] = n
    return columns


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 3e-4, limit: int = 3000) -> tuple[np.ndarray, np.ndarray]:
    """Columns of a near-optimal basis of the cutting-stock program, and how often to use each.

    The patterns of a best-fit packing may enter before the knapsack prices others. It stops when
    the dual bound is within `gap` of the solution, or after `limit` exchanges.
    """
    m = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    x = inverse @ demand
    cost = np.ones(m)
    pool = fitted(sizes, demand.astype(np.int64), capacity)
    for _ in range(limit):
        y = cost @ inverse
        low = int(y.argmin())
        worth = y @ pool
        if y[low] < -1e-9:  # more pieces than asked for are allowed
            column, price = -np.eye(m)[low], 0.0
        elif worth.max(initial=0) > 1 + 1e-6:
            column, price = pool[:, int(worth.argmax())], 1.0
        else:
            value, counts = knapsack(y, sizes, capacity)
            if value <= 1 + gap:
                break
            column, price = counts.astype(float), 1.0
        d = inverse @ column
        up = np.flatnonzero(d > 1e-9)
        ratio = x[up] / d[up]
        r = int(up[ratio.argmin()])
        step = x[r] / d[r]
        x = np.maximum(x - step * d, 0)
        x[r] = step
        row = inverse[r] / d[r]
        inverse -= np.outer(d, row)
        inverse[r] = row
        columns[:, r], cost[r] = column, price
    used = cost > 0
    return columns[:, used].astype(np.int64), x[used]


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end rank, first sequence, pieces of the class in a sequence): where the ranked pieces of each class go."""
    sizes = np.array(sorted(histogram), np.int64)
    left = np.array([histogram[int(s)] for s in sizes], np.int64)
    rank = np.zeros(len(sizes), np.int64)
    out: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    if len(sizes):
        columns, x = patterns(sizes, left.astype(float), capacity)
        for k in np.argsort(-x, kind="stable"):
            times = int(x[k] + 1e-9)
            if times:
                for c in np.flatnonzero(columns[:, k]):
                    a = int(columns[c, k])
                    n = int(min(left[c], a * times))
                    if n:
                        out.append((int(sizes[c]), int(rank[c]), int(rank[c]) + n, sequence, a))
                        rank[c] += n
                        left[c] -= n
                sequence += times
    rooms: list[tuple[int, int]] = []  # (room, sequence), sorted
    for c in range(len(sizes) - 1, -1, -1):
        for _ in range(int(left[c])):
            i = bisect_left(rooms, (int(sizes[c]), -1))
            if i < len(rooms):
                room, s = rooms.pop(i)
            else:
                room, s = capacity, sequence
                sequence += 1
            out.append((int(sizes[c]), int(rank[c]), int(rank[c]) + 1, s, 1))
            rank[c] += 1
            insort(rooms, (room - int(sizes[c]), s))
    return out


def packed(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of each piece of `docs`."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = F.ceil(F.col("length") / QUANTUM).cast("long")
    pieces = staged(texts.mapInArrow(_pieces(path, length), PIECES), "pieces").withColumn("class", kind)
    counted = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count("*").alias("n")).collect()}  # length / QUANTUM rows at most
    places = plan(counted, length // QUANTUM)
    schema = "class bigint, lo bigint, hi bigint, base bigint, each bigint"
    # LP patterns are at most length / QUANTUM, and so bound the rows of this table; so does the rest that they leave.
    table = F.broadcast(spark.createDataFrame(places, schema))
    sizes = F.broadcast(spark.createDataFrame([(c, n) for c, n in counted.items()], "class bigint, n bigint"))
    ranges: Column = F.least(F.lit(MAX_RANGES), F.ceil(F.col("n") / ROWS_PER_RANGE)).cast("long")
    dealt = pieces.join(sizes, "class").withColumn("range", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), ranges))
    before = (
        dealt.groupBy("class", "range").agg(F.count("*").alias("k"))
        .withColumn("before", F.coalesce(F.sum("k").over(Window.partitionBy("class").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("class", "range", "before")
    )
    inside = Window.partitionBy("class", "range").orderBy("doc_id", "start", "ids_crc32")
    ranked = dealt.join(before, ["class", "range"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    at = F.col("rank") - F.col("lo")
    placed = (
        ranked.join(table, (ranked["class"] == table["class"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
        .withColumn("sequence_id", F.col("base") + F.floor(at / F.col("each")))
        .withColumn("slot", F.pmod(at, F.col("each")))
    )
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0))).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))
