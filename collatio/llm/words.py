"""Words of whole Arrow columns as numpy arrays.

A word is a maximal run of bytes outside space, tab, \\n, \\v, \\f and \\r. All functions
work on the concatenated UTF-8 of a chunk of documents, so their cost per document is small
and their memory is bounded by the chunk (`CHUNK_BYTES`, or one document if it is longer).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1_000_000

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LANES = ((np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)), (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)))
_KEPT = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
#: Longer byte ranges are hashed by BLAKE2b, one by one.
BLOCKWISE = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lanes: int = 2, blockwise: int = BLOCKWISE) -> list[np.ndarray]:
    """One or two independent 64-bit hashes of data[s:e] for each range.

    Blocks of 8 bytes go through a bijection one after another, otherwise in each lane, so that no
    algebraic relation between the bytes makes texts equal in both; long ranges have a BLAKE2b digest.
    """
    sizes = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    out = [mix(sizes.astype(np.uint64) * m + c) for m, c in _LANES[:lanes]]
    at = np.flatnonzero((sizes > 0) & (sizes <= blockwise))
    step = 0
    while len(at):
        x = blocks[starts[at] + step] & _KEPT[np.minimum(sizes[at] - step, 8)]
        out[0][at] = mix(out[0][at] ^ x)
        if lanes > 1:
            out[1][at] = mix(out[1][at] * _LANES[1][0] + (x << np.uint64(29) | x >> np.uint64(35)))
        step += 8
        at = at[sizes[at] > step]
    for i in np.flatnonzero(sizes > blockwise).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=16).digest()
        for k in range(lanes):
            out[k][i] = int.from_bytes(digest[8 * k : 8 * k + 8], "little")
    return out


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two sequences, a before b, of their hashes."""
    return mix(a * np.uint64(0xE7037ED1A0B428DB) + (b << np.uint64(31) | b >> np.uint64(33)) + np.uint64(0x8EBC6AF09C88C6E3))


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of each k neighbours of h, from those of 1, 2, 4, ... neighbours."""
    out, at, size = None, 0, 1
    n = len(h) - k + 1
    while k:
        if k & 1:
            out = h[at : at + n] if out is None else joined(out, h[at : at + n])
            at += size
        k >>= 1
        if k:
            h = joined(h[:-size], h[size:])
            size *= 2
    return out


def alike(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Keys that are equal where both hashes are: `one`, unless it is equal somewhere where `two` isn't."""
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        return np.unique(np.stack([one, two], axis=1), axis=0, return_inverse=True)[1].ravel().astype(np.uint64)
    return one


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and each row's offsets in them."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary()) if pa.types.is_binary(column.type) else column.cast(pa.large_string())
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1] if off is not None and len(column) else np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


class Words:
    """Word boundaries and hashes of a chunk of documents.

    first[d]:first[d + 1] are the words of document d; word i is data[start[i]:end[i]].
    """

    def __init__(self, column: pa.Array, lower: bool = False) -> None:
        data, self.offsets = utf8(column)
        self.data = LOWER[data] if lower else data
        space = SPACE[data]
        word = ~space
        before = np.ones(len(data), bool)
        before[1:] = space[:-1]
        after = np.ones(len(data), bool)
        after[:-1] = space[1:]
        full = self.offsets[1:] > self.offsets[:-1]
        before[self.offsets[:-1][full]] = True
        after[self.offsets[1:][full] - 1] = True
        self.start = np.flatnonzero(word & before)
        self.end = np.flatnonzero(word & after) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.space = space

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lanes: int = 2) -> list[np.ndarray]:
        """One or two independent hashes of each word."""
        return byte_hashes(self.data, self.start, self.end, lanes)

    def windows(self, k: int, *hashes: np.ndarray) -> list[np.ndarray]:
        """First word of each run of k words of one document, in order, and the hash of the run from each given hash."""
        n = len(self.start) - k + 1
        if n <= 0:
            return [np.zeros(0, np.int64), *(np.zeros(0, np.uint64) for _ in hashes)]
        doc = self.documents()
        at = np.flatnonzero(doc[:n] == doc[k - 1 :])
        return [at, *(run_hashes(h, k)[at] for h in hashes)]


def per_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values[offsets[d]:offsets[d + 1]]."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:], dtype=np.int64)
    return total[offsets[1:]] - total[offsets[:-1]]
