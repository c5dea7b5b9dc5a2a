"""Toxicity by a bidirectional gated recurrent network with attention pooling, written and trained in numpy.

A token is a letter run in lower case, longer ones than `LONGEST` in pieces. Its input joins a word vector
and the mean of the vectors of its character grams (both hashed into tables of fixed size), so unseen words
are read by their spelling. The vectors begin as noise and are learnt with the network. Windows of `WIDTH`
tokens, each starting `STRIDE` after the last one, cover every text whole; two recurrent passes read a window,
attention pools their states, and a document's score is a calibrated logistic of its highest window.

The network is fitted on a bounded sample of labelled documents (`PER_LABEL` of each label): from each,
the window that seems most toxic, first by how often labels hold its words, then to the network itself, and of
documents that aren't toxic one at random. Everything else runs over all documents. Null, empty and letterless
texts are scored as one empty window. Without rows of both labels there is nothing to learn, and all scores are
0. Rows are independent of each other: repeated ones get a row each, ids may be null, long texts are read whole,
and an empty table gives an empty result. Of rows with one id one text is learnt from, and none with a null id;
only doc_id and toxic of the labels are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collatio.llm.letters import Runs
from collatio.llm.sampling import draw, held_out
from collatio.llm.staging import small_batches
from collatio.llm.words import chunks, joined, mix, run_hashes

WIDTH, STRIDE = 24, 8
WORDS, GRAMS = 1 << 16, 1 << 15
DIM, HIDDEN = 4, 8
#: Spread of the first vectors, and how much faster than the network they learn.
NOISE, FASTER = 0.1, 10
#: How often the windows to learn from are chosen, first by the slots' odds, then by the network itself.
ROUNDS = 2
#: Documents of the sample that hold a slot which is learnt.
LEAST = 3
PER_LABEL = 2500
LONGEST = 32  # letters of a token
EPOCHS, BATCH, RATE = 4, 256, 0.01
#: Small samples are read more often, until there are so many steps or epochs.
STEPS, MOST_EPOCHS = 250, 20
THRESHOLD = 0.3
#: Characters that the fit reads at a time.
FIT_CHUNK = 400_000


class Tokens:
    """The distinct tokens of a chunk with the slots of their vectors, and which token stands where."""

    def __init__(self, column: pa.Array) -> None:
        r = Runs(column, LONGEST)
        h, first, self.at = np.unique(r.hashes(), return_index=True, return_inverse=True)
        self.first, self.hash = r.first, h
        self.word = (h & np.uint64(WORDS - 1)).astype(np.int64)
        size = r.end[first] - r.start[first]
        end = np.cumsum(size)
        start = end - size
        # Only the distinct tokens' letters are read.
        points = mix(r.points[np.arange(int(size.sum())) + np.repeat(r.start[first] - start, size)].astype(np.uint64) + np.uint64(3))
        # All runs of 3 characters, and the first 3 to 7 ones, marked as such; a shorter token is one itself.
        n3 = np.maximum(end - start - 2, 0)
        owner = np.repeat(np.arange(len(start)), n3)
        s3 = start[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n3) - n3, n3)
        short = np.flatnonzero(n3 == 0)
        last = points[end[short] - 1]
        grams, owners = [np.where(end[short] - start[short] > 1, joined(points[start[short]], last), last)], [short]
        for k in (3, 4, 5, 6, 7):
            runs = run_hashes(points, k) if len(points) >= k else points[:0]
            if k == 3:
                grams.append(runs[s3])
                owners.append(owner)
            long = np.flatnonzero(end - start >= k)
            grams.append(mix(runs[start[long]] + np.uint64(k)))
            owners.append(long)
        owner, gram = np.concatenate(owners), (np.concatenate(grams) >> np.uint64(20)) & np.uint64(GRAMS - 1)
        order = np.argsort(owner, kind="stable")
        self.gram, self.edges = gram[order].astype(np.int64), np.searchsorted(owner[order], np.arange(len(start) + 1))

    def part(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The gram slots of some distinct tokens, one after another, which of them each belongs to, and how many each has."""
        size = np.diff(self.edges)[ids]
        owner = np.repeat(np.arange(len(ids)), size)
        return self.gram[self.edges[ids][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)], owner, size

    @classmethod
    def joined(cls, parts: list[tuple[Tokens, np.ndarray]]) -> tuple[Tokens, list[np.ndarray]]:
        """Some distinct tokens of several chunks as one set, and for each chunk which of it its tokens are."""
        out = cls.__new__(cls)
        hashes = np.concatenate([t.hash[ids] for t, ids in parts])
        out.hash, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        out.word = np.concatenate([t.word[ids] for t, ids in parts])[first]
        pieces = [t.part(ids) for t, ids in parts]
        gram, size = np.concatenate([p[0] for p in pieces]), np.concatenate([p[2] for p in pieces])
        begin = np.cumsum(size) - size
        n = size[first]
        owner = np.repeat(np.arange(len(first)), n)
        out.gram = gram[begin[first][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)]
        out.edges = np.concatenate([[0], np.cumsum(n)])
        return out, np.split(at, np.cumsum([len(ids) for _, ids in parts])[:-1])

    def inputs(self, words: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """The input vector of each distinct token, and a last one of zeros for what is past a text's end."""
        out = np.zeros((len(self.word) + 1, words.shape[1] + grams.shape[1]), np.float32)
        if len(self.word):
            out[:-1, : words.shape[1]] = words[self.word]
            out[:-1, words.shape[1] :] = np.add.reduceat(grams[self.gram], self.edges[:-1], axis=0) / np.diff(self.edges)[:, None]
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct token at each place of each window, and the windows' documents."""
        n = np.diff(self.first)
        count = np.maximum(1, -(-(n - WIDTH) // STRIDE) + 1)
        doc = np.repeat(np.arange(len(n)), count)
        begin = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
        place = begin[:, None] + np.arange(WIDTH)
        inside = place < n[doc][:, None]
        where = np.where(inside, self.first[:-1][doc][:, None] + place, 0)
        return np.where(inside, self.at[where] if len(self.at) else 0, len(self.word)), doc


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _gru(x: np.ndarray, index: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (steps, windows, HIDDEN) for projected inputs x, read in the order of index's columns."""
    h = np.zeros((len(index), HIDDEN), np.float32)
    out = np.empty((index.shape[1], len(index), HIDDEN), np.float32)
    for t in range(index.shape[1]):
        g = x[index[:, t]]
        a = h @ u
        zr = _sigmoid(g[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(g[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        if keep is not None:
            keep.append((h, z, r, n, a[:, 2 * HIDDEN :]))
        h = new
        out[t] = h
    return out


class Network:
    def __init__(self, words: np.ndarray, grams: np.ndarray) -> None:
        rs = np.random.RandomState(4)
        size = words.shape[1] + grams.shape[1]
        self.words, self.grams = words, grams
        near = lambda *s: (rs.randn(*s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"wf": near(size, 3 * HIDDEN), "bf": np.zeros(3 * HIDDEN, np.float32), "uf": near(HIDDEN, 3 * HIDDEN), "wb": near(size, 3 * HIDDEN), "bb": np.zeros(3 * HIDDEN, np.float32), "ub": near(HIDDEN, 3 * HIDDEN), "att": near(2 * HIDDEN, 1)[:, 0], "out": near(2 * HIDDEN, 1)[:, 0], "c": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def logits(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Of all windows, and their documents."""
        p, index = self.p, None
        index, doc = tokens.windows()
        e = tokens.inputs(self.words, self.grams)
        xf, xb = e @ p["wf"] + p["bf"], e @ p["wb"] + p["bb"]
        out = np.empty(len(index), np.float32)
        for s in range(0, len(index), 1024):
            i = index[s : s + 1024]
            h = np.concatenate([_gru(xf, i, p["uf"]), _gru(xb, i[:, ::-1], p["ub"])[::-1]], axis=2)
            a = h @ p["att"]
            w = np.exp(a - a.max(0))
            out[s : s + 1024] = ((h @ p["out"]) * w).sum(0) / w.sum(0) + p["c"]
        return out, doc

    def gradients(self, e: np.ndarray, index: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Of the mean cross-entropy, by the parameters and by the rows of e."""
        p, n, steps = self.p, len(index), index.shape[1]
        kf: list = []
        kb: list = []
        hf = _gru(e @ p["wf"] + p["bf"], index, p["uf"], kf)
        hb = _gru(e @ p["wb"] + p["bb"], index[:, ::-1], p["ub"], kb)
        h = np.concatenate([hf, hb[::-1]], axis=2)
        a = h @ p["att"]
        w = np.exp(a - a.max(0))
        w /= w.sum(0)
        o = h @ p["out"]
        pooled = (o * w).sum(0)
        prob = _sigmoid(pooled + p["c"])
        loss = float(-np.mean(np.log(np.where(y > 0, prob, 1 - prob) + 1e-7)))
        d = (prob - y) / n
        da = w * (o - pooled) * d
        g = {"c": np.array([d.sum()], np.float32), "out": np.einsum("tnh,tn->h", h, w * d), "att": np.einsum("tnh,tn->h", h, da)}
        dh = (w * d)[:, :, None] * p["out"] + da[:, :, None] * p["att"]
        de = np.zeros_like(e)
        for name, keep, ways, idx in (("f", kf, dh[:, :, :HIDDEN], index), ("b", kb, dh[::-1, :, HIDDEN:], index[:, ::-1])):
            u, back = p["u" + name], np.zeros((n, HIDDEN), np.float32)
            dx = np.zeros((len(e), 3 * HIDDEN), np.float32)
            g["u" + name] = np.zeros_like(u)
            for t in range(steps - 1, -1, -1):
                h0, z, r, c, an = keep[t]
                up = ways[t] + back
                dn = up * (1 - z) * (1 - c * c)
                dz = up * (h0 - c) * z * (1 - z)
                dr = dn * an * r * (1 - r)
                da3 = np.concatenate([dz, dr, dn * r], axis=1)
                g["u" + name] += h0.T @ da3
                back = up * z + da3 @ u.T
                np.add.at(dx, idx[:, t], np.concatenate([dz, dr, dn], axis=1))
            g["w" + name], g["b" + name] = e.T @ dx, dx.sum(0)
            de += dx @ p["w" + name].T
        return g, de, loss

    def scores(self, column: pa.Array) -> np.ndarray:
        """The score of each text: its highest window's logit, calibrated."""
        return 1 / (1 + np.exp(-(self.scale * self.highest(Tokens(column), len(column)) + self.shift)))

    def highest(self, tokens: Tokens, n: int) -> np.ndarray:
        """The logit of the highest window of each of n documents."""
        logit, doc = self.logits(tokens)
        top = np.full(n, -np.inf)
        np.maximum.at(top, doc, logit)
        return top


def _log_odds(counts: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How much more often toxic documents hold a slot than others do, from how many of each label hold it."""
    a, b = ((counts[v] + 0.5) / (max(1, (y == v).sum()) + 1) for v in (1, 0))
    seen = counts.sum(0)
    return (np.log(a / b) * (seen / (seen + 4))).astype(np.float32)


class _Kept:
    """What is kept of a chunk's tokens."""

    def __init__(self, tokens: Tokens, ids: np.ndarray) -> None:
        self.hash, self.word = tokens.hash[ids], tokens.word[ids]
        self.gram, _, size = tokens.part(ids)
        self.edges = np.concatenate([[0], np.cumsum(size)])

    part = Tokens.part


def fit(texts: list[str], y: np.ndarray) -> Network | None:
    """A network of labelled texts, or None if they have one label only. Texts are read in small chunks."""
    if not (0 < y.sum() < len(y)):
        return None
    rs = np.random.RandomState(5)
    # Every fifth text is left for the calibration, if there is enough of both labels.
    own = np.arange(len(y)) % 5 != 4
    if len({*y[own]}) > 1 and len({*y[~own]}) > 1:
        later = [(t, v) for t, v, o in zip(texts, y, own, strict=True) if not o]
        texts, y = [t for t, o in zip(texts, own, strict=True) if o], y[own]
    else:
        later = list(zip(texts, y, strict=True))
    cuts = np.flatnonzero(np.diff(np.cumsum([len(t) for t in texts]) // FIT_CHUNK)) + 1
    ranges = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True))
    read = lambda a, b: Tokens(pa.array(texts[a:b], pa.string()))
    holds_word, holds_gram = np.zeros((2, WORDS)), np.zeros((2, GRAMS))
    for a, b in ranges:
        t = read(a, b)
        for d in range(b - a):
            own = np.unique(t.at[t.first[d] : t.first[d + 1]])
            holds_word[y[a + d], np.unique(t.word[own])] += 1
            holds_gram[y[a + d], np.unique(t.part(own)[0])] += 1
    # The vectors begin as noise, those of slots that fewer documents hold stay 0; how often labels hold a slot only says which windows to learn from.
    net = Network(*(NOISE * rs.randn(h.shape[1], DIM).astype(np.float32) * (h.sum(0) >= LEAST)[:, None] for h in (holds_word, holds_gram)))
    net.past = [np.where(v.any(1, keepdims=True), 1e-12, np.inf).astype(np.float32) * np.ones(DIM, np.float32) for v in (net.words, net.grams)]
    odds = [_log_odds(h, y)[:, None] for h in (holds_word, holds_gram)]
    first_guess = lambda t, index: t.inputs(*odds).max(1)[index].max(1)
    own_guess = lambda t, index: net.logits(t)[0]
    moments: dict[str, list] = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    step = 0
    for guess in (first_guess, *[own_guess] * (ROUNDS - 1)):
        tokens, index, target = _lessons(texts, y, ranges, read, guess, rs)
        batch = min(BATCH, max(32, len(index) // 16))
        epochs = max(EPOCHS, min(MOST_EPOCHS, STEPS * batch // len(index)))
        for epoch in range(epochs):
            turn = rs.permutation(len(index))
            for s in range(0, len(turn), batch):
                t = turn[s : s + batch]
                used, local = np.unique(index[t], return_inverse=True)
                sub = _Subset(tokens, used)
                g, de, _ = net.gradients(sub.inputs(net.words, net.grams), local.reshape(len(t), WIDTH), target[t])
                step += 1
                rate = RATE * (1 - epoch / epochs)
                for k, v in net.p.items():
                    m = moments[k]
                    m[0] = 0.9 * m[0] + 0.1 * g[k]
                    m[1] = 0.999 * m[1] + 0.001 * g[k] ** 2
                    v -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
                sub.update(net, de, rate)
    top = np.concatenate([net.highest(Tokens(pa.array([t], pa.string())), 1) for t, _ in later])
    net.scale, net.shift = _calibrated(top, np.array([v for _, v in later]))
    del net.past
    return net


def _lessons(texts: list[str], y: np.ndarray, ranges: list[tuple[int, int]], read, guess, rs: np.random.RandomState) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """The windows to learn from: of each text the one that `guess` finds most toxic, and of others than toxic ones one at random."""
    kept: list[tuple[_Kept, np.ndarray]] = []
    places: list[np.ndarray] = []
    goals: list[np.ndarray] = []
    for a, b in ranges:
        t = read(a, b)
        index, doc = t.windows()
        order = np.lexsort((-guess(t, index), doc))
        first, count = np.searchsorted(doc[order], np.arange(b - a)), np.bincount(doc, minlength=b - a)
        other = order[first + (rs.rand(b - a) * count).astype(np.int64)]
        chosen = np.concatenate([order[first], other[y[a:b] == 0]])
        used, local = np.unique(index[chosen], return_inverse=True)
        real = used[used < len(t.word)]
        kept.append((_Kept(t, real), np.arange(len(real))))
        places.append(local.reshape(len(chosen), WIDTH))
        goals.append(y[a:b][doc[chosen]])
    tokens, ids = Tokens.joined(kept)
    index = np.concatenate([np.append(i, len(tokens.word))[p] for i, p in zip(ids, places, strict=True)])
    return tokens, index, np.concatenate(goals).astype(np.float32)


class _Subset:
    """Some distinct tokens of a chunk, for training; the last one may be the empty one."""

    def __init__(self, tokens: Tokens, used: np.ndarray) -> None:
        self.tokens, self.used = tokens, used
        self.real = used < len(tokens.word)
        ids = used[self.real]
        self.gram, self.owner, self.size = tokens.part(ids)
        self.word = tokens.word[ids]

    def inputs(self, words: np.ndarray, grams: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.used), 2 * DIM), np.float32)
        mean = np.zeros((len(self.word), DIM), np.float32)
        np.add.at(mean, self.owner, grams[self.gram])
        out[self.real] = np.concatenate([words[self.word], mean / self.size[:, None]], axis=1)
        return out

    def update(self, net: Network, de: np.ndarray, rate: float) -> None:
        """A step on the vectors of the tokens, each slot's as long as its past gradients allow."""
        d = de[self.real]
        for table, past, slots, g in ((net.words, net.past[0], self.word, d[:, :DIM]), (net.grams, net.past[1], self.gram, (d[:, DIM:] / self.size[:, None])[self.owner])):
            own, at = np.unique(slots, return_inverse=True)
            total = np.zeros((len(own), DIM), np.float32)
            np.add.at(total, at, g)
            past[own] += total * total
            table[own] -= FASTER * rate * total / (np.sqrt(past[own]) + 1e-8)


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic of x, by damped Newton steps with a small ridge on the scale."""
    mid, spread = x.mean(), x.std() + 1e-6
    u = np.stack([(x - mid) / spread, np.ones(len(x))])
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    ab = np.array([0.0, np.log(rate / (1 - rate))])

    def loss(ab: np.ndarray) -> float:
        z = ab @ u
        return float(np.logaddexp(0, -z * (2 * y - 1)).sum() + 0.05 * ab[0] ** 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(ab @ u, -30, 30)))
        g = u @ (p - y) + np.array([0.1 * ab[0], 0])
        h = (u * (p * (1 - p) + 1e-9)) @ u.T + np.diag([0.1, 1e-9])
        d = np.linalg.solve(h, g)
        t = 1.0
        while t > 1e-4 and loss(ab - t * d) > loss(ab):
            t /= 2
        ab = ab - t * d
        if np.abs(t * d).max() < 1e-6:
            break
    a = max(ab[0], 1e-3) / spread
    return float(a), float(ab[1] - a * mid)


def trained(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Of labelled documents that aren't held out, PER_LABEL of each label or so."""
    rows = labels.where("toxic in (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    # So few rows at most that they may be sent to every executor.
    some = F.broadcast(draw(rows, "toxic", PER_LABEL, "doc_id").select("doc_id", "toxic", "draw"))
    # Of rows with one id one text is learnt from, so no more come to the driver than were drawn.
    found = docs.select("doc_id", "text").join(some, "doc_id").where("text is not null").groupBy("doc_id", "toxic", "draw").agg(F.min("text").alias("text")).collect()
    found = sorted(found, key=lambda r: (r["draw"], r["toxic"], r["text"]))
    return fit([r["text"] for r in found], np.array([r["toxic"] for r in found], np.int64))


def scored(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id and score of each row."""
    held = docs.sparkSession.sparkContext.broadcast(net)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, limit=1_000_000):
            score = held.value.scores(b.column("text")) if held.value is not None else np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score.astype(np.float64))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, score double")
