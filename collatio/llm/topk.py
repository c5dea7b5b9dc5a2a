"""Exact top-k inner products through an index of pivots and distance annuli.

`Index.build` keys each vector by its nearest pivot and the annulus of its distance to it; the
pivots and annulus bounds are fitted on a sample of at most `SAMPLE` vectors, and every vector is
keyed. For a query q and a cell with radii r0..r1 about pivot p, the triangle inequality gives
|q - x| >= max(|q - p| - r1, r0 - |q - p|, 0), and q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2; it also gives
q.x <= q.p + |q| r1. The lower of both is a cell's upper bound. Each query first takes its best cells, which
gives it a k-th score, then expands the cells in order of their bounds until one is below that score.

A cell is cut into blocks of about `BLOCK` vectors, and so are the queries that visit it: a task holds one
block of each, however large a cell (equal vectors, say) or the query set is, and a cell's vectors are sent
once for each block of queries that visit it. `visits` says how many vectors queries were compared with.

Rows with a null id, and vectors that are null, or hold null or non-finite components, take no part. Shorter
vectors count as padded with 0. Components beyond `HUGE` are kept in a cell of their own that every query
visits, and queries with such visit all cells; scores beyond 64 bits count as the greatest or least number
that these hold. Ties go to the smaller id. Equal rows are candidates each on their own; of query rows with
one id the smallest vector counts. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from collatio.llm.staging import small_batches, staged

SAMPLE = 2048
BLOCK = 2048
#: Vectors that a cell holds on average, until there are MAX_PIVOTS * MAX_RINGS cells.
CELL = 256
#: Scaled components beyond this have no usable distances.
HUGE = 2.0**40
_APART = -1
LEAST_SCORE = -(2**63)
MAX_PIVOTS = MAX_RINGS = 64
#: Vectors that the first cells of a query hold at least.
FIRST = 512


def matrix(column: pa.Array, scale: float, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of the usable vectors of a list column as float64, and which rows they are."""
    flat = column.flatten()
    lengths = np.asarray(column.value_lengths().fill_null(-1), dtype=np.int64)
    values = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)  # null components become NaN
    at = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    rows = np.flatnonzero((lengths >= 0) & (bad[at[1:]] == bad[at[:-1]]))
    width = int(max(lengths.max(initial=0), dim or 0))
    out = np.zeros((len(rows), width))
    if len(rows) and width and (lengths[rows] == width).all():
        out[:] = values[(at[rows][:, None] + np.arange(width))]
    else:
        for k, r in enumerate(rows):
            out[k, : lengths[r]] = values[at[r] : at[r + 1]]
    # Beyond the range of doubles the product is kept at its end; scores are then far beyond 64 bits anyway.
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * scale), -np.finfo(float).max, np.finfo(float).max), rows


def _pad(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    width = max(x.shape[1], p.shape[1])
    x, p = _pad(x, width), _pad(p, width)
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1) - 2 * (x @ p.T), 0))


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: through float64 while those are exact, else through Python's integers, held to 64 bits."""
    width = max(q.shape[1], x.shape[1])
    q, x = _pad(q, width), _pad(x, width)
    if width == 0 or np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * width < 2**53:
        return (q @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(q) @ whole(x).T, LEAST_SCORE, 2**63 - 1).astype(np.int64)


class Index:
    """Pivots, cells and the keyed vectors (id, vector, cell, salt)."""

    def __init__(self, vectors: DataFrame, pivots: np.ndarray, edges: np.ndarray, cells: list[tuple], rows: DataFrame, scale: float) -> None:
        self.vectors, self.pivots, self.edges, self.cells, self.rows, self.scale = vectors, pivots, edges, cells, rows, scale

    @classmethod
    def build(cls, vectors: DataFrame, scale: float = 1.0) -> Index:
        """Of the columns id and vector of `vectors`."""
        small_batches(vectors.sparkSession)
        vectors = vectors.where("id is not null")
        n = vectors.count()
        sample = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
        points, _ = matrix(sample.column("vector").combine_chunks(), scale)
        points = points[(np.abs(points) <= HUGE).all(1)]
        n_pivots = int(min(MAX_PIVOTS, max(1, n // (4 * CELL)), max(1, len(points))))
        n_rings = int(min(MAX_RINGS, max(1, n // (n_pivots * CELL))))
        pivots = points[:1] if len(points) else np.zeros((1, points.shape[1] if points.ndim == 2 else 0))
        while len(pivots) < n_pivots:
            far = distances(points, pivots).min(1)
            pivots = np.concatenate([pivots, points[[int(far.argmax())]]])
        near = distances(points, pivots).min(1) if len(points) else np.zeros(1)
        edges = np.quantile(near, np.linspace(0, 1, n_rings + 1)[1:-1])

        def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x, rows = matrix(b.column("vector"), scale)
                if not len(rows):
                    continue
                huge = (np.abs(x) > HUGE).any(1)
                x[huge] = 0
                d = distances(x, pivots)
                p = d.argmin(1)
                r = np.where(huge, 0, d[np.arange(len(d)), p])
                cell = np.where(huge, _APART, p * MAX_RINGS + np.searchsorted(edges, r))
                b = b.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vector"), pa.array(cell.astype(np.int64)), pa.array(r), pa.array((x * x).sum(1))], names=["id", "vector", "cell", "radius", "norm"])

        kind = vectors.schema["vector"].dataType.simpleString()
        rows = staged(vectors.mapInArrow(key, f"id bigint, vector {kind}, cell bigint, radius double, norm double"), "pivot-index")
        cells = [(c["cell"], c["n"], c["r0"], c["r1"], c["norm"]) for c in rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("radius").alias("r0"), F.max("radius").alias("r1"), F.max("norm").alias("norm")).collect()]  # at most MAX_PIVOTS * MAX_RINGS
        return cls(vectors, pivots, edges, sorted(cells), rows, scale)

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, rank, id, score): the k best other rows of each row (id, vector) of `queries`."""
        cells, pivots, scale = self.cells, self.pivots, self.scale
        kind = queries.schema["vector"].dataType.simpleString()
        queries = staged(queries.where("id is not null").groupBy("id").agg(F.min("vector").alias("vector")), "topk-queries")
        c_id = np.array([c[0] for c in cells], np.int64)
        c_n = np.array([c[1] for c in cells], np.int64)
        c_r0, c_r1, c_norm = (np.array([c[i] for c in cells], float) for i in (2, 3, 4))
        apart = c_id == _APART
        out = f"id bigint, vector {kind}, cell bigint"

        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                q, rows = matrix(b.column("vector"), scale)
                if not len(rows) or not len(c_id):
                    continue
                b = b.take(pa.array(rows))
                huge = (np.abs(q) > HUGE).any(1)
                q[huge] = 0
                width = max(q.shape[1], pivots.shape[1])
                own, far = _pad(q, width), _pad(pivots, width)
                near_p = np.where(apart, 0, c_id // MAX_RINGS)
                dq = distances(q, pivots)[:, near_p]
                slack = 1e-6 * (1 + dq + c_r1)
                near = np.maximum(np.maximum(dq - c_r1, c_r0 - dq) - slack, 0)
                qq = (q * q).sum(1)[:, None]
                ball = (own @ far.T)[:, near_p] + np.sqrt(qq) * c_r1
                bound = np.minimum((qq + c_norm - near**2) / 2, ball) + 1e-6 * (1 + qq + c_norm)
                bound[:, apart] = np.inf
                bound[huge] = np.inf
                order = np.argsort(-bound, axis=1, kind="stable")
                behind = np.cumsum(c_n[order], axis=1) - c_n[order]
                first = np.zeros(bound.shape, bool)
                np.put_along_axis(first, order, behind < FIRST, axis=1)
                if "least" in b.schema.names:
                    least = np.array([-np.inf if v is None else v for v in b.column("least").to_pylist()])
                    take = ~first & (bound >= least[:, None])
                else:
                    take = first
                at, c = np.nonzero(take)
                ids = np.asarray(b.column("id"))[at]
                for s in range(0, len(at), 4096):
                    z = slice(s, s + 4096)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[z]), b.column("vector").take(pa.array(at[z])), pa.array(c_id[c[z]])], names=["id", "vector", "cell"])

        def meet(x: pa.Table, q: pa.Table) -> pa.Table:
            if not x.num_rows or not q.num_rows:
                return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
            vx, _ = matrix(x.column("vector").combine_chunks(), scale)
            vq, _ = matrix(q.column("vector").combine_chunks(), scale)
            xi, qi = np.asarray(x.column("id")), np.asarray(q.column("id"))
            by = np.argsort(xi, kind="stable")
            xi, vx = xi[by], vx[by]
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for s in range(0, len(qi), 256):
                sc = scores(vq[s : s + 256], vx)
                own = qi[s : s + 256, None] == xi
                sc = np.where(own, LEAST_SCORE, sc)
                best = np.argsort(np.where(own, 2**63 - 1, ~sc), axis=1, kind="stable")[:, : k + 1]  # stable: ties stay by id
                got = np.take_along_axis(sc, best, 1)
                ok = ~np.take_along_axis(own, best, 1)
                r, c = np.nonzero(ok)
                found.append((qi[s : s + 256][r], xi[best[r, c]], got[r, c]))
            a, b, c = (np.concatenate(z) for z in zip(*found, strict=True))
            return pa.table({"query_id": a, "id": b, "score": c})

        keys = ["cell", "salt", "part"]
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        salts, parts = F.ceil(F.col("rows") / BLOCK).cast("bigint"), F.ceil(F.col("asked") / BLOCK).cast("bigint")

        def round_of(q: DataFrame, name: str) -> DataFrame:
            asked = staged(q.mapInArrow(expand, out), f"topk-{name}")
            # At most MAX_PIVOTS * MAX_RINGS + 1 rows.
            sizes = asked.groupBy("cell").agg(F.count("*").alias("asked")).join(self.rows.groupBy("cell").agg(F.count("*").alias("rows")), "cell")
            sizes = F.broadcast(staged(sizes, "topk-visits"))
            x = self.rows.join(sizes, "cell").withColumn("salt", F.pmod(F.xxhash64("id"), salts)).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
            y = asked.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("id"), parts)).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
            self.visits.append(sizes)
            met = x.select("id", "vector", *keys).groupBy(*keys).cogroup(y.select("id", "vector", *keys).groupBy(*keys)).applyInArrow(meet, "query_id bigint, id bigint, score bigint")
            return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

        self.visits: list[DataFrame] = []
        self.asked = queries
        first = staged(round_of(queries, "first"), "topk-found")
        least = first.groupBy(F.col("query_id").alias("q")).agg(F.max(F.when(F.col("rank") == k, F.col("score"))).cast("double").alias("least"))
        rest = round_of(queries.join(least, F.col("id") == F.col("q"), "left").select("id", "vector", "least"), "rest")
        both = first.select("query_id", "id", "score").unionByName(rest.select("query_id", "id", "score"))
        return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")

    def compared(self) -> tuple[int, int]:
        """How many pairs of a query and a vector the last search compared, and how many there are."""
        pairs = [v.agg(F.sum(F.col("asked") * F.col("rows"))).first()[0] or 0 for v in self.visits]
        return sum(pairs), self.asked.count() * self.rows.count()
