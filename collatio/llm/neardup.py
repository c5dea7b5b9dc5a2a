"""MinHash near-duplicates through a multi-index Hamming join of b-bit signatures.

A document's set are its distinct k-word shingles. Its signature are `SYMBOLS` minimum hashes of
`b` = 16 bits each. Two documents are candidates if their signatures differ in `reach` symbols at
most: the number expected at the similarity threshold and 4.5 standard deviations. All symbols are
cut into chunks, so many that by the pigeonhole principle signatures within that distance have a chunk
with one wrong symbol at most; each chunk is entered once for each symbol that may be wrong, under the
hash of its other symbols. So all pairs within the distance meet, and a candidate is a link only if
the full sets, told by a second hash of every shingle, confirm it.

Equal sets are one class from the start, told by a digest of the set. Groups that share a key and
have up to `SMALL` members give all candidates; in a larger one each member first gives its nearest
other member, and after the components of what that confirms are known, the candidates between
different components, but for those that shingles no other member has already rule out. So a group
of copies costs links in proportion to its size, and candidates of different components are all
confirmed or refuted. Before the texts of the latter are fetched, second signatures of `WIDE` symbols
are compared, which lose a pair at the threshold with a chance below 4e-6; `certain=True` leaves that
out, and then no pair within the distance is lost. Groups of over `BLOCK` members are cut into
blocks, and every two blocks meet in a task.

Null, empty and wordless texts have no set and no links. Fewer words than k: the whole sequence is
the one shingle. Long texts are read whole. Rows with a null id take no part in linking (component
null, kept true). Repeated rows share a component, each with its own row. Rows of one id and
different texts are one node. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collatio.llm.components import components
from collatio.llm.idfilter import possible
from collatio.llm.staging import small_batches, staged
from collatio.llm.words import Words, chunks, joined, mix

SYMBOLS = 64
#: Symbols of the second signature, of documents in large groups alone.
WIDE = 1024
SMALL = 12
BLOCK = 1024
#: Keys with more than this share of all entries are joined by broadcast; there are no more than the inverse of them.
HOT = 1e-5
#: Bits of a shingle's key that tell the documents of a chunk apart.
_ROW_BITS = 12
_A = np.random.RandomState(7).randint(0, 2**31, SYMBOLS + WIDE).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_B = np.random.RandomState(8).randint(0, 2**32, SYMBOLS + WIDE, dtype=np.uint64).astype(np.uint32)


def reach(threshold: float, symbols: int = SYMBOLS) -> int:
    """The greatest signature distance of a candidate."""
    p = 1 - threshold
    return min(symbols - 1, math.ceil(symbols * p + 4.5 * math.sqrt(symbols * p * (1 - p))))


def chunks_for(far: int) -> list[np.ndarray]:
    """The symbols of each chunk: so many chunks that `far` wrong symbols leave one with one of them at most."""
    return np.array_split(np.arange(SYMBOLS), far // 2 + 1)


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Chunks of as many rows at most as a shingle's key can tell apart."""
    for b in chunks(batches, column, 1_000_000):
        for s in range(0, b.num_rows, 1 << _ROW_BITS):
            yield b.slice(s, 1 << _ROW_BITS)


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The row of each shingle, in no order, and its two hashes."""
    w = Words(column, lower=True)
    h = w.hashes()
    at, *found = w.windows(k, *h)
    rows = [w.documents()[at]]
    parts = [[x] for x in found]
    for n in range(1, k):
        short = np.flatnonzero(w.counts == n)
        rows.append(short)
        for own, x in zip(parts, h, strict=True):
            v = x[w.first[short]]
            for i in range(1, n):
                v = joined(v, x[w.first[short] + i])
            own.append(v)
    return np.concatenate(rows), [np.concatenate(x) for x in parts]


def by_row(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct shingles of n rows, each as row and 52 bits of hash, where each row begins, and one place of each."""
    keys, first = np.unique((rows.astype(np.uint64) << np.uint64(64 - _ROW_BITS)) | (hashes >> np.uint64(_ROW_BITS)), return_index=True)
    edges = np.searchsorted(keys, np.arange(n, dtype=np.uint64) << np.uint64(64 - _ROW_BITS))
    return keys, np.append(edges, len(keys)), first


def shingle_sets(column: pa.Array, k: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """`by_row` of the shingles of a column, by their first or second hash."""
    rows, hashes = shingles(column, k)
    return by_row(rows, hashes[lane], len(column))[:2]


def signatures(keys: np.ndarray, edges: np.ndarray, first: int = 0, symbols: int = SYMBOLS, kind: type = np.uint16) -> np.ndarray:
    """Symbols `first` to `first + symbols` of the signature of each row that has shingles, in order."""
    full = np.flatnonzero(edges[1:] > edges[:-1])
    x = (mix(keys << np.uint64(_ROW_BITS)) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(full), symbols), kind)
    starts = edges[full]
    for i in range(symbols):
        k = first + i
        low = np.minimum.reduceat(x * _A[k] + _B[k], starts) if len(full) else np.zeros(0, np.uint32)
        out[:, i] = (mix(low.astype(np.uint64) + np.uint64(k + 1)) >> np.uint64(48)).astype(kind)
    return out


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows, hashes = shingles(b.column("text"), k)
            keys, edges, at = by_row(rows, hashes[0], b.num_rows)
            n = np.diff(edges)
            full = np.flatnonzero(n)
            sums = [np.add.reduceat(mix(h[at] + np.uint64(s)), edges[full]) if len(full) else at[:0].astype(np.uint64) for s, h in enumerate(hashes, 1)]
            digest = np.ascontiguousarray(np.stack(sums, axis=1)).view(np.uint8).reshape(len(full), 16)
            sig = signatures(keys, edges).view(np.uint8)

            def binary(a: np.ndarray, full: np.ndarray = full, rows: int = b.num_rows) -> pa.Array:
                offsets = np.zeros(rows + 1, np.int32)
                offsets[full + 1] = a.shape[1]
                return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(np.cumsum(offsets, dtype=np.int32)), pa.py_buffer(a.tobytes())])

            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n.astype(np.int64)), binary(digest), binary(sig)], names=["doc_id", "n_shingles", "digest", "sig"])

    return run


def _matrix(column: pa.Array, kind: type = np.uint16) -> np.ndarray:
    if not len(column):
        return np.zeros((0, SYMBOLS), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _chunk_keys(sig: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """The keys of each signature: of each chunk, without one of its symbols; the k-th lacks symbol k."""
    out = np.empty(sig.shape, np.uint64)
    for part in parts:
        for j in part:
            value = np.full(len(sig), j + 1, np.uint64)
            for i in part:
                if i != j:
                    value = mix(value << np.uint64(16) ^ value >> np.uint64(48) ^ sig[:, i].astype(np.uint64))
            out[:, j] = value
    return out


def _keys(parts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 4000):
                x = b.slice(s, 4000)
                keys = _chunk_keys(_matrix(x.column("sig")), parts)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(x.column("rep")), SYMBOLS)), pa.array(keys.ravel().view(np.int64))], names=["rep", "key"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by `columns` in batches that don't part equal ones."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        key = np.stack([np.asarray(b.column(c)) for c in columns])
        last = np.flatnonzero((key != key[:, -1:]).any(0))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            held[-1] = b.slice(0, cut)
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = [b.slice(cut)]
        elif len(held) > 1 and any(held[-2].column(c)[-1] != b.column(c)[0] for c in columns):
            yield pa.Table.from_batches(held[:-1]).combine_chunks().to_batches()[0]
            held = held[-1:]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _lone(k: int):
    """Texts to the distinct shingles of a chunk: (shingle, n, rep), n the documents that have it and rep one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            keys, _ = shingle_sets(b.column("text"), k)
            bare, first, n = np.unique(keys & np.uint64((1 << (64 - _ROW_BITS)) - 1), return_index=True, return_counts=True)
            row = (keys[first] >> np.uint64(64 - _ROW_BITS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bare.view(np.int64)), pa.array(n.astype(np.int64)), b.column("doc_id").take(pa.array(row))], names=["shingle", "n", "rep"])

    return run


def _wide(k: int):
    """Texts to their second signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            keys, edges = shingle_sets(b.column("text"), k)
            full = pa.array(np.flatnonzero(np.diff(edges)))
            wide = signatures(keys, edges, SYMBOLS, WIDE, np.uint8)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(full), pa.array([w.tobytes() for w in wide], pa.binary())], names=["rep", "wide"])

    return run


def _candidates(parts: list[np.ndarray], far: int, near_only: bool, percent: int):
    """Rows (key, i, j, n, block, rep, comp, size, lone, sig, wide), sorted by key, i and j, to candidate pairs (a, b).

    A pair that shares several keys is a candidate of the first one; a member of a large group looks for its
    nearest other one in the keys of two chunks. Two sets share at most what either has
    beside its lone shingles; pairs that can't reach the threshold with that are none.
    """

    chunk_of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    begin = np.array([p[0] for p in parts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _groups(batches, ("key", "i", "j")):
            key, i, j, n, block, rep, comp, size, lone = (np.asarray(b.column(c)) for c in ("key", "i", "j", "n", "block", "rep", "comp", "size", "lone"))
            common = size - lone
            sig = _matrix(b.column("sig"))
            wide = _matrix(b.column("wide"), np.uint8) if "wide" in b.schema.names else None
            far_wide = reach(percent / 100, WIDE)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            group = np.cumsum(new)
            best, whom = np.full(len(key), far + 1), np.full(len(key), -1)
            out: list[tuple[np.ndarray, np.ndarray]] = []
            at = np.arange(len(key))
            step = 1
            while True:
                at = at[at + step < len(key)]
                at = at[group[at] == group[at + step]]
                if not len(at):
                    break
                x, y = at, at + step
                ok = ((i[x] == j[x]) | (block[x] != block[y])) & (rep[x] != rep[y]) & (comp[x] != comp[y])
                most = np.minimum(common[x], common[y])
                ok &= 100 * most >= percent * (size[x] + size[y] - most)
                x, y = x[ok], y[ok]
                for s in range(0, len(x), 20_000):
                    p, q = x[s : s + 20_000], y[s : s + 20_000]
                    wrong = sig[p] != sig[q]
                    d = wrong.sum(1)
                    ok = d <= far
                    p, q, d, wrong = p[ok], q[ok], d[ok], wrong[ok]
                    if wide is not None and len(p):
                        ok = (wide[p] != wide[q]).sum(1) <= far_wide
                        p, q, wrong = p[ok], q[ok], wrong[ok]
                    if near_only:
                        big = n[p] > SMALL
                        for u, v, w in ((p[big], q[big], d[big]), (q[big], p[big], d[big])):
                            closer = w < best[u]
                            best[u[closer]], whom[u[closer]] = w[closer], v[closer]
                        p, q, wrong = p[~big], q[~big], wrong[~big]
                    errors = np.add.reduceat(wrong, begin, axis=1, dtype=np.int64)
                    c = (errors <= 1).argmax(1)
                    here = wrong & (chunk_of == c[:, None])
                    lacks = np.where(here.any(1), here.argmax(1), begin[c])
                    first = _first_key(sig[p], c, lacks, parts)
                    ok = first.view(np.int64) == key[p]
                    out.append((rep[p[ok]], rep[q[ok]]))
                step += 1
            if near_only:
                u = np.flatnonzero(whom >= 0)
                place = chunk_of[(_chunk_keys(sig[u], parts).view(np.int64) == key[u, None]).argmax(1)] if len(u) else u
                turn = (mix(rep[u].view(np.uint64)) % np.uint64(len(parts))).astype(np.int64)
                u = u[((place - turn) % len(parts)) < 2]
                out.append((rep[u], rep[whom[u]]))
            if out:
                a, c = (np.concatenate(z) for z in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, c)), pa.array(np.maximum(a, c))], names=["a", "b"])

    return run


def _first_key(sig: np.ndarray, c: np.ndarray, lacks: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """The key of chunk c without symbol `lacks`, for each row."""
    out = np.empty(len(sig), np.uint64)
    for k, part in enumerate(parts):
        at = np.flatnonzero(c == k)
        value = (lacks[at] + 1).astype(np.uint64)
        for i in part:
            value = np.where(lacks[at] == i, value, mix(value << np.uint64(16) ^ value >> np.uint64(48) ^ sig[at, i].astype(np.uint64)))
        out[at] = value
    return out


def _verify(k: int, percent: int):
    """Rows (a, b, left, right) to the (u, v) whose sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "left"):
            x, ex = shingle_sets(b.column("left"), k, 1)
            y, ey = shingle_sets(b.column("right"), k, 1)
            both = np.intersect1d(x, y, assume_unique=True)
            common = np.bincount((both >> np.uint64(64 - _ROW_BITS)).astype(np.int64), minlength=b.num_rows)
            union = np.diff(ex) + np.diff(ey) - common
            ok = pa.array((union > 0) & (100 * common >= percent * union))
            yield pa.RecordBatch.from_arrays([b.column("b").filter(ok), b.column("a").filter(ok)], names=["u", "v"])

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    pairs = staged(pairs.where("a <> b").distinct(), "neardup-candidates")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    texts = possible(texts, "doc_id", ids)
    left, right = texts.alias("l"), texts.alias("r")
    rows = pairs.join(left, F.col("a") == F.col("l.doc_id")).select("a", "b", F.col("l.text").alias("left")).join(right, F.col("b") == F.col("r.doc_id")).select("a", "b", "left", F.col("r.text").alias("right"))
    return staged(rows.mapInArrow(_verify(k, percent), "u bigint, v bigint").where("u <> v"), "neardup-links")


def _with_key(rows: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """Rows (key, rep, ...) with what `found` (key, n, ...) has of their key; rows of other keys go.

    n is how many rows have the key. Keys of many are few, and broadcast, so that no task gets all rows of one.
    """
    held = F.struct(*(c for c in found.columns if c != "key"))
    much = F.col("n") > max(BLOCK, int(total * HOT))
    hot = F.broadcast(found.where(much).select("key", held.alias("f1")))
    cold = found.where(~much).select(F.col("key").alias("k2"), held.alias("f2"))
    dealt = rows.join(hot, "key", "left").withColumn("k1", F.when(F.col("f1").isNull(), F.col("key")).otherwise(F.xxhash64("rep")))
    both = dealt.join(cold, (F.col("k1") == F.col("k2")) & F.col("f1").isNull(), "left").withColumn("f", F.coalesce("f1", "f2"))
    return both.where("f is not null").select(*rows.columns, "f.*")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id", certain: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row.

    Documents with 100 * intersection >= percent * union are linked, k-word shingles being compared.
    """
    threshold = percent / 100
    small_batches(docs.sparkSession)
    far = reach(threshold)
    parts = chunks_for(far)
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    sets = staged(texts.mapInArrow(_sets(k), "doc_id bigint, n_shingles bigint, digest binary, sig binary"), "neardup-sets")
    classes = staged(sets.where("n_shingles > 0 and doc_id is not null").groupBy("digest", "sig", F.col("n_shingles").alias("size")).agg(F.min("doc_id").alias("rep")), "neardup-classes")
    entries = classes.select("rep", "sig").mapInArrow(_keys(parts), "rep bigint, key bigint")
    often = staged(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "neardup-keys")
    total = classes.count() * SYMBOLS
    shared = staged(_with_key(entries, often, total).select("key", "rep", "n"), "neardup-shared")

    def met(members: DataFrame, near_only: bool) -> DataFrame:
        blocks = F.ceil(F.col("n") / BLOCK).cast("long")
        own = F.pmod(F.xxhash64("rep"), blocks)
        dealt = members.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        return (
            dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "n", "block", "rep", "comp", "size", "lone", "sig", *(c for c in ("wide",) if c in members.columns))
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(_candidates(parts, far, near_only, percent), "a bigint, b bigint")
        )

    sigs = classes.select("rep", "size", "sig")
    first = met(shared.withColumn("comp", F.col("rep")).join(sigs, "rep").withColumn("lone", F.lit(0).cast("long")), True)
    links = _confirmed(first, texts, k, percent)
    large = shared.where(F.col("n") > SMALL)
    if not large.isEmpty():
        found = staged(components(links), "neardup-first-components")
        labelled = large.join(found, F.col("rep") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "rep"))
        split = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("key", "n")
        members = staged(_with_key(labelled.select("key", "rep", "comp"), split, total).select("key", "rep", "n", "comp"), "neardup-members")
        reps = members.select(F.col("rep").alias("r")).distinct()
        own = staged(possible(texts, "doc_id", reps).join(reps, F.col("doc_id") == F.col("r")).select("doc_id", "text"), "neardup-member-texts")
        once = own.mapInArrow(_lone(k), "shingle bigint, n bigint, rep bigint").groupBy("shingle").agg(F.sum("n").alias("n"), F.min("rep").alias("rep")).where("n = 1")
        lone = once.groupBy("rep").agg(F.count("*").alias("lone"))
        signed = members.join(sigs, "rep")
        if not certain:
            signed = signed.join(own.mapInArrow(_wide(k), "rep bigint, wide binary").distinct(), "rep")
        second = met(signed.join(lone, "rep", "left").withColumn("lone", F.coalesce("lone", F.lit(0).cast("long"))), False)
        links = found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(_confirmed(second, texts, k, percent))
    found = components(links)
    ids = classes.join(found, F.col("rep") == F.col("node"), "left").select(F.col("digest").alias("d"), F.coalesce("component", "rep").alias("component"))
    # A document without a set is its own; a null id has none.
    rows = sets.select("doc_id", "n_shingles", "digest").join(ids, (F.col("digest") == F.col("d")) & (F.col("n_shingles") > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` with one document of each component left, one with the smallest id.

    A document is an id and a text, so different texts of one id are documents of their own. Of rows
    that share both one stays; rows with a null id stay.
    """
    names = docs.columns
    id_ = F.col("doc_id").cast("long")
    marked = docs.withColumn("__node", F.when(id_.isNotNull(), F.xxhash64(id_, F.col("text").cast("string"))))
    found = near_duplicates(marked, k, percent, key="__node").where("doc_id is not null").select(F.col("doc_id").alias("__node"), "component_id").distinct()
    nodes = staged(found.join(marked.where("__node is not null").select("__node", id_.alias("__id")).distinct(), "__node"), "neardup-nodes")
    groups = nodes.groupBy(F.col("component_id").alias("key")).agg(F.count("*").alias("n"), F.min(F.struct("__id", "__node"))["__node"].alias("first")).where("n > 1")
    gone = _with_key(nodes.select(F.col("component_id").alias("key"), F.col("__node").alias("rep")), staged(groups, "neardup-groups"), nodes.count()).where("rep <> first").select(F.col("rep").alias("__node"))
    rest = marked.join(gone, "__node", "left_anti")
    named = rest.where("__node is not null").groupBy("__node").agg(F.min(F.struct(*(F.col(f"`{c}`") for c in names))).alias("__row")).select("__row.*")
    return named.unionByName(rest.where("__node is null").select(*(F.col(f"`{c}`") for c in names)))
