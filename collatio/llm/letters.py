"""Lower-case code points of whole Arrow columns, and their letter runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from collatio.llm.words import byte_hashes, utf8

_letter: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letter:
        _letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letter[0]


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased code points of a string column (null: empty) and each row's offsets in them."""
    low = pc.utf8_lower(column.fill_null("") if column.null_count else column)
    data, _ = utf8(low)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    offsets = np.zeros(len(column) + 1, np.int64)
    np.cumsum(pc.utf8_length(low).to_numpy(zero_copy_only=False), out=offsets[1:])
    return points, offsets


class Runs:
    """Letter runs of a chunk of documents: run i is points[start[i]:end[i]], first[d]:first[d + 1] those of document d.

    Longer runs than `longest` are cut into pieces of that many letters.
    """

    def __init__(self, column: pa.Array, longest: int = 32) -> None:
        self.points, self.offsets = code_points(column)
        ok = is_letter()[self.points]
        edge = np.zeros(len(ok) + 1, bool)
        edge[self.offsets] = True  # documents part runs
        before = np.concatenate([[False], ok[:-1]]) if len(ok) else ok
        after = np.concatenate([ok[1:], [False]]) if len(ok) else ok
        self.start = np.flatnonzero(ok & (~before | edge[:-1]))
        self.end = np.flatnonzero(ok & (~after | edge[1:])) + 1
        parts = -(-(self.end - self.start) // longest)
        if (parts > 1).any():
            start = np.repeat(self.start, parts) + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * longest
            self.start, self.end = start, np.minimum(start + longest, np.repeat(self.end, parts))
        self.first = np.searchsorted(self.start, self.offsets)

    def hashes(self) -> np.ndarray:
        return byte_hashes(self.points.view(np.uint8), 4 * self.start, 4 * self.end, 1, 128)[0]
