"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of labelled text. A text is parsed by it into phrases,
each the longest match with the language's text from where the last one ended; the language that
needs the fewest phrases, times the bits of a place in its text, wins. All documents of a chunk
are parsed in step: texts are letters with single blanks between words, in segments of
`SEGMENT`, which only costs a phrase at each segment's end in every language alike.

Learnt from a sample of labelled documents: whole ones, in the order of a hash, until a language has
`LETTERS` letters, and of `DOCUMENTS` at most; so an automaton is larger than that bound by its last
document at most. Every letter counts, in every script. The transitions of a language's `DENSE` commonest
letters are a table, those of all others are sorted pairs. Null texts and such without a letter are `und`
with score 0, and so is everything if nothing could be learnt. The score is the share of phrases that the
best language saves against the second. Equal costs go to the smaller name. Rows are independent; repeated
ones get a row each, and long texts are parsed whole; an empty table gives an empty result. Rows with a
null id may be learnt from, each by its own text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collatio.llm.letters import code_points, is_letter
from collatio.llm.sampling import draw, held_out
from collatio.llm.staging import small_batches
from collatio.llm.words import chunks

SEGMENT = 512
DOCUMENTS = 60
LETTERS = 24_000
DENSE = 32


def normalised(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters, and 32 for each run of others behind a letter, with each row's offsets."""
    ok = is_letter()[points]
    before = np.zeros(len(ok), bool)
    before[1:] = ok[:-1]
    inner = offsets[:-1][offsets[:-1] < len(ok)]
    before[inner] = False
    keep = ok | before
    total = np.concatenate([[0], np.cumsum(keep)])
    return np.where(ok, points, 32)[keep], total[offsets]


def automaton(text: np.ndarray) -> list[dict[int, int]]:
    """The suffix automaton of a sequence of codes: the next states of each state."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text.tolist():
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] != length[p] + 1:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = copy
                    p = link[p]
                link[q] = copy
                q = copy
            link[new] = q
        last = new
    return nxt


class Language:
    """One automaton: a table for common letters, sorted (state, letter) pairs for the others."""

    def __init__(self, text: np.ndarray, n_codes: int) -> None:
        states = automaton(text)
        common = [c for c, _ in Counter(text.tolist()).most_common(DENSE)]
        self.dense = np.full(n_codes + 1, DENSE, np.int8)
        self.dense[common] = np.arange(len(common))
        self.n_codes, self.bits = n_codes, float(np.log2(len(text) + 1))
        self.table = np.full((len(states), DENSE + 1), -1, np.int32)
        rare: list[tuple[int, int]] = []
        for s, to in enumerate(states):
            for c, t in to.items():
                if self.dense[c] < DENSE:
                    self.table[s, self.dense[c]] = t
                else:
                    rare.append((s * n_codes + c, t))
        rare.sort()
        self.table = self.table.ravel()
        self.keys, self.targets = (np.array(x, np.int64) for x in zip(*rare, strict=True)) if rare else (np.zeros(0, np.int64),) * 2

    def next(self, state: np.ndarray, dense: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next state of each, -1 for none."""
        to = self.table[state * (DENSE + 1) + dense]
        if len(self.keys):
            rare = np.flatnonzero((dense == DENSE) & (codes < self.n_codes))
            if len(rare):
                key = state[rare].astype(np.int64) * self.n_codes + codes[rare]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                to[rare] = np.where(self.keys[at] == key, self.targets[at], -1)
        return to

    def phrases(self, codes: np.ndarray, begin: np.ndarray, active: np.ndarray) -> np.ndarray:
        """The phrases of segments of codes, of which active[t] are longer than t, the longest first."""
        dense = self.dense[codes]
        state, count = np.zeros(len(begin), np.int32), np.ones(len(begin), np.int64)
        for t, n in enumerate(active.tolist()):
            c, d = codes[begin[:n] + t], dense[begin[:n] + t]
            to = self.next(state[:n], d, c)
            miss = np.flatnonzero(to < 0)
            count[miss] += 1
            to[miss] = np.maximum(self.next(np.zeros(len(miss), np.int32), d[miss], c[miss]), 0)
            state[:n] = to
        return count


class Model:
    """The automata of the languages, and the codes of the letters that any of them knows."""

    def __init__(self, texts: dict[str, str]) -> None:
        points, offsets = normalised(*code_points(pa.array(list(texts.values()), pa.string())))
        parts = {name: points[offsets[i] : offsets[i + 1]] for i, name in enumerate(texts)}
        self.letters = np.unique(points)
        self.names = sorted(n for n in parts if len(parts[n]))
        self.languages = [Language(self.codes(parts[n]), len(self.letters)) for n in self.names]
        self.bits = [x.bits for x in self.languages]

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Each letter's number; that of unknown ones is the number of known ones."""
        if not len(self.letters):
            return np.zeros(len(points), np.int32)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at, len(self.letters)).astype(np.int32)

    def phrases(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The phrases of each text (rows) in each language, and the letters and blanks of each text."""
        points, offsets = normalised(*code_points(column))
        codes = self.codes(points)
        lengths = np.diff(offsets)
        parts = -(-lengths // SEGMENT)
        doc = np.repeat(np.arange(len(lengths)), parts)
        begin = offsets[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * SEGMENT
        size = np.minimum(SEGMENT, offsets[1:][doc] - begin)
        order = np.argsort(-size, kind="stable")
        doc, begin, size = doc[order], begin[order], size[order]
        active = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), side="left")
        total = np.zeros((len(lengths), len(self.names)), np.int64)
        for k, language in enumerate(self.languages):
            total[:, k] = np.bincount(doc, weights=language.phrases(codes, begin, active), minlength=len(lengths))
        return total, lengths

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.names:
            return ["und"] * len(column), np.zeros(len(column))
        found, lengths = self.phrases(column)
        cost = found * np.array(self.bits)
        best = cost.argmin(1)
        rows = np.arange(len(cost))
        low = cost[rows, best]
        if len(self.names) > 1:
            others = cost.copy()
            others[rows, best] = np.inf
            score = 1 - low / np.maximum(others.min(1), 1e-9)
        else:
            score = np.ones(len(cost))
        some = lengths > 0
        return [self.names[b] if s else "und" for b, s in zip(best.tolist(), some.tolist(), strict=True)], np.where(some, np.clip(score, 0, 1), 0.0)


def learn(docs: DataFrame) -> Model:
    """A model of the labelled rows (doc_id, text, lang) of `docs`."""
    rows = docs.where("lang is not null and text is not null").select("lang", "text", F.col("doc_id").alias("a"), F.xxhash64("text").alias("b"))
    # The sample is of bounded size: so many documents a language. Equal rows are one.
    found = draw(rows, "lang", 2 * DOCUMENTS, "a", "b").select("lang", "draw", "text").distinct().collect()
    texts: dict[str, list[str]] = {}
    size: Counter[str] = Counter()
    for r in sorted(found, key=lambda r: (r["lang"], r["draw"], r["text"])):
        n, own = sum(map(str.isalpha, r["text"])), texts.setdefault(r["lang"], [])
        if n and len(own) < DOCUMENTS and size[r["lang"]] < LETTERS:
            own.append(r["text"])
            size[r["lang"]] += n
    return Model({n: " ".join(t) for n, t in texts.items() if t})


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of each row."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            names, score = held.value.predict(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def trained(docs: DataFrame) -> Model:
    """Of the rows that aren't held out."""
    return learn(docs.where(~held_out(F.col("doc_id"))))
