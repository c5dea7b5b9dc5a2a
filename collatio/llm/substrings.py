"""Substring deduplication against a log-structured index of window fingerprints.

A window is `WINDOW` consecutive words. Every window has an anchor: the least hash of the `GRAM`-word
runs in it. Equal windows have equal anchors, so only windows whose anchor occurs twice can be
repeated, and neighbouring windows share anchors, which are an eighth of the windows.

The index consists of sorted immutable runs, in buckets. An anchor run has the anchors of a batch, how
often each occurs, and a document that has it. A window run has the window hashes under anchors that
occur more than once: a hash of the window's words (64 bits), 32 bits of a second one from other hashes
of the same words, and the first document and place. `Index.ingest` merge-joins a batch's anchors with
the earlier anchor runs, reads the batch's windows under repeated anchors, merge-joins them with the
earlier window runs, and leaves what is new as a run of its own; both hashes must agree for windows to
count as equal. As soon as there are more than `fanout` runs of a kind, two are merged into one. Texts
of earlier batches are not read again, but for the documents of an anchor that occurred once before and
that the new batch is the first to repeat. Of batches ingested together each text is read twice,
however many batches there are. An index can be kept in a folder and opened again.

A window is a repetition if its words also start earlier: in a smaller doc_id, or earlier in the
same document. Batches must come in the order of doc_id. Equal windows within a chunk of documents
are settled there, so that a passage of a third of all documents sends one row per chunk, and equal
windows are compared in a stream, so a task holds none of them.

Null, empty and short texts have no window; long ones are read whole. A document is an id and a text:
different texts of one id are documents of their own, in the order of a hash of theirs, and equal rows
are one document that keeps equal words in each. Rows with a null doc_id are left whole and aren't
indexed. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.llm.idfilter import bits_of, maybe, parted, possible
from collatio.llm.staging import removed, shared_folder, small_batches, staged, swept
from collatio.llm.words import Words, chunks, mix

WINDOW = 20
GRAM = 5
BATCHES = 4
FANOUT = 2


def _sliding(v: np.ndarray, width: int, best) -> np.ndarray:
    """The least (np.minimum) or greatest of each `width` neighbours of v."""
    done = 1
    while done < width:
        step = min(done, width - done)
        v = best(v[:-step], v[step:]) if len(v) > step else v[:0]
        done += step
    return v


def anchors(w: Words, one: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows' first words, their anchors, and the places that are anchors with their hashes."""
    at, gram = w.windows(GRAM, one)
    span = WINDOW - GRAM + 1
    if len(at) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros((2, 0), np.uint64)
    doc = w.documents()
    inside = (at[span - 1 :] - at[: len(at) - span + 1] == span - 1) & (doc[at[span - 1 :]] == doc[at[: len(at) - span + 1]])
    least = _sliding(gram, span, np.minimum)
    # A gram is an anchor if some window of its document has it as the least.
    padded = np.zeros(len(gram) + span - 1, np.uint64)
    padded[span - 1 : span - 1 + len(least)] = np.where(inside, least, np.uint64(0))
    chosen = (_sliding(padded, span, np.maximum) == gram) & (gram > 0)
    return at[: len(least)][inside], least[inside], np.stack([doc[at[chosen]].astype(np.uint64), gram[chosen]])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches):
        w = Words(b.column("text"))
        row, gram = anchors(w, w.hashes(1)[0])[2]
        g, first, n = np.unique(gram, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n.astype(np.int64)), b.column("doc").take(pa.array(row[first].astype(np.int64)))], names=["g", "n", "doc"])


#: wh: hash of a window. at: 32 bits of its second hash, and the place of its first word in the document.
#: n: 0 for a window that may be new; of windows that repeat others of their chunk a run of n is one row.
ROWS = "wh bigint, at bigint, doc bigint, tid bigint, n bigint"
_PLACE = np.uint64(0xFFFFFFFF)


def _table(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns.values()], names=list(columns))


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _window_rows(held):
    """Windows under anchors of a filter as ROWS; of equal ones in a chunk, only the first.

    The others are in rows of runs, under keys of their own, with the run's start as `at`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            w = Words(b.column("text"))
            lanes = w.hashes()
            at, anchor, _ = anchors(w, lanes[0])
            ok = maybe(held.value, anchor.view(np.int64))
            where, one, two = w.windows(WINDOW, *lanes)
            one, two, at = one[ok], two[ok] >> np.uint64(32), at[ok]
            row = w.documents()[at]
            doc, tid, place = np.asarray(b.column("doc"))[row], np.asarray(b.column("tid"))[row], at - w.first[row]
            order = np.lexsort((place, tid, doc, two, one))
            one, two, doc, tid, place = (x[order] for x in (one, two, doc, tid, place))
            first = _heads(one, two)
            lead = np.flatnonzero(first)[np.cumsum(first) - 1] if len(one) else np.zeros(0, np.int64)
            again = np.flatnonzero((doc != doc[lead]) | (tid != tid[lead]) | (place != place[lead]))
            yield _table(wh=one[first], at=(two[first] << np.uint64(32)) | place[first].astype(np.uint64), doc=doc[first], tid=tid[first], n=np.zeros(int(first.sum()), np.int64))
            if len(again):
                d, t, p = np.unique(np.stack([doc[again], tid[again], place[again]]), axis=1)
                head = np.flatnonzero(_heads(d, t, p - np.arange(len(p))))
                spread = mix(d[head].view(np.uint64) ^ mix(t[head].view(np.uint64) ^ mix(p[head].astype(np.uint64))))
                yield _table(wh=spread, at=p[head], doc=d[head], tid=t[head], n=np.diff(np.append(head, len(d))))

    return run


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ROWS with `old`, whether an earlier run has the window, sorted by window, document and place, to ROWS.

    n is 0 for the first of its words, and 1 or more for repeated ones, whose `at` is the place alone.
    Rows are told from the one before them, so nothing but that one is held.
    """
    last: tuple[int, ...] | None = None
    for b in batches:
        wh, at, doc, tid, n = (np.asarray(b.column(c)) for c in ("wh", "at", "doc", "tid", "n"))
        old = np.asarray(b.column("old").to_numpy(zero_copy_only=False))
        done = n > 0
        yield _table(wh=wh[done], at=at[done], doc=doc[done], tid=tid[done], n=n[done])
        wh, at, doc, tid, old = wh[~done], at[~done].view(np.uint64), doc[~done], tid[~done], old[~done]
        if not len(wh):
            continue
        check = (at >> np.uint64(32)).astype(np.int64)
        new = _heads(wh, check)
        if last is not None and last[:2] == (wh[0], check[0]):
            new[0] = False
        # The first of each window: a row of this batch, or the last one's.
        lead = np.maximum.accumulate(np.where(new, np.arange(len(wh)), -1))
        of = lambda x, k: np.where(lead >= 0, x[lead], last[k] if last is not None else 0)
        firsts = of(doc, 2), of(tid, 3), of(at.view(np.int64), 4)
        again = old | (doc != firsts[0]) | (tid != firsts[1]) | (at.view(np.int64) != firsts[2])
        fresh = new & ~old
        yield _table(wh=wh[again], at=at[again] & _PLACE, doc=doc[again], tid=tid[again], n=np.ones(int(again.sum()), np.int64))
        yield _table(wh=wh[fresh], at=at[fresh], doc=doc[fresh], tid=tid[fresh], n=np.zeros(int(fresh.sum()), np.int64))
        last = (int(wh[-1]), int(check[-1]), *(int(f[-1]) for f in firsts))


class Index:
    """Anchor runs and window runs, each a table in buckets, sorted within them, in a folder."""

    ANCHORS, WINDOWS = "anchors", "windows"
    COLUMNS = {ANCHORS: ("g", "g BIGINT, n BIGINT, doc BIGINT"), WINDOWS: ("wh", ROWS)}

    def __init__(self, spark: SparkSession, folder: str | None = None, fanout: int = FANOUT, buckets: int | None = None) -> None:
        """A new index, in a folder that is deleted when the process ends if none is given."""
        small_batches(spark)
        self.spark, self.fanout, self.saved = spark, fanout, 0
        self.folder = folder or swept(spark, f"{shared_folder(spark)}/window-index-{uuid.uuid4().hex}")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: dict[str, list[str]] = {self.ANCHORS: [], self.WINDOWS: []}

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> Index:
        """The index that `save` left in a folder."""
        latest = max((json.loads(r["value"]) for r in spark.read.text(f"{folder}/manifest-*").collect()), key=lambda m: m["saved"])
        found = cls(spark, folder, latest["fanout"], latest["buckets"])
        found.runs, found.saved = latest["runs"], latest["saved"]
        for kind, names in found.runs.items():
            key, schema = cls.COLUMNS[kind]
            for name in names:
                spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {found.buckets} BUCKETS LOCATION '{folder}/{name}'")
        return found

    def save(self) -> None:
        """Writes down which runs there are; older runs that were merged are deleted only then."""
        self.saved += 1
        state = json.dumps({"saved": self.saved, "fanout": self.fanout, "buckets": self.buckets, "runs": self.runs})
        self.spark.createDataFrame([(state,)], "value string").coalesce(1).write.text(f"{self.folder}/manifest-{self.saved:06d}")

    def _write(self, rows: DataFrame, kind: str) -> str:
        name, key = f"{kind}_run_{uuid.uuid4().hex}", self.COLUMNS[kind][0]
        try:
            rows.write.bucketBy(self.buckets, key).sortBy(key).option("path", f"{self.folder}/{name}").saveAsTable(name)
        except BaseException:
            self._drop(name)
            raise
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        removed(self.spark, f"{self.folder}/{name}")

    def _windows(self, run: str) -> DataFrame:
        return self.spark.table(run).where("n = 0").select("wh", F.shiftrightunsigned("at", 32).alias("check"), "at", "doc", "tid")

    def _merged(self, a: str, b: str, kind: str) -> str:
        """Two runs as one: a join of sorted buckets, without a shuffle."""
        if kind == self.ANCHORS:
            x, y = self.spark.table(a), self.spark.table(b).select("g", F.col("n").alias("m"), F.col("doc").alias("d"))
            rows = x.join(y, "g", "full").select("g", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).cast("long").alias("n"), F.coalesce("doc", "d").alias("doc"))
        else:
            x, y = (self._windows(r).select("wh", F.struct("at", "doc", "tid").alias(c)) for r, c in ((a, "x"), (b, "y")))
            both = x.join(y, "wh", "full").select("wh", F.explode(F.filter(F.array("x", "y"), lambda v: v.isNotNull())).alias("v"))
            rows = both.select("wh", "v.at", "v.doc", "v.tid", F.lit(0).cast("long").alias("n"))
        return self._write(rows, kind)

    def _add(self, runs: list[str], name: str, kind: str) -> None:
        """A run more; beyond `fanout` the two last ones are merged."""
        runs.append(name)
        while len(runs) > self.fanout:
            b, a = runs.pop(), runs.pop()
            runs.append(self._merged(a, b, kind))
            self._drop(a), self._drop(b)

    def ingest(self, batches: list[DataFrame], earlier: DataFrame | None = None) -> DataFrame:
        """(doc, tid, start, n): runs of n windows of `batches` (doc, tid, text) that repeat earlier ones.

        `earlier` are the documents of former calls; those whose only occurrence of an anchor is now repeated are read again.
        """
        held, new, met, single = tuple(self.runs[self.ANCHORS]), [], [], []
        for batch in batches:
            found = batch.mapInArrow(_anchor_rows, "g bigint, n bigint, doc bigint")
            run = self._write(found.repartition(self.buckets, "g").groupBy("g").agg(F.sum("n").alias("n"), F.min("doc").alias("doc")), self.ANCHORS)
            fresh = self.spark.table(run).select("g", "n")
            own = fresh.where("n > 1").select("g", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("doc"))
            for r in (*held, *new):
                # What an earlier run of this call has is no old anchor, so its n doesn't count.
                n = F.col("m") if r in held else F.lit(0).cast("long")
                own = own.unionByName(fresh.select("g").join(self.spark.table(r).select("g", F.col("n").alias("m"), "doc"), "g").select("g", n.alias("n"), "doc"))
            met.append(staged(own, "repeated-anchors"))
            self._add(new, run, self.ANCHORS)
        repeated = met[0]
        for m in met[1:]:
            repeated = repeated.unionByName(m)
        held_bits = self.spark.sparkContext.broadcast(bits_of(staged(repeated.select("g").distinct(), "repeated-anchors")))
        if held and earlier is not None:
            # Whichever batches met it, an old anchor of one occurrence has no windows in the index yet.
            once = repeated.where("n > 0").distinct().groupBy("g").agg(F.sum("n").alias("n"), F.min("doc").alias("doc")).where("n = 1")
            once = staged(once, "single-anchors")
            if not once.isEmpty():
                bits = self.spark.sparkContext.broadcast(bits_of(once.select("g")))
                ids = once.select(F.col("doc").alias("d")).distinct()
                again = possible(earlier, "doc", ids).join(ids, F.col("doc") == F.col("d"), "left_semi")
                self._told_windows(again, bits)
        gone = None
        for batch in batches:
            run = self._told_windows(batch, held_bits)
            part = staged(self.spark.table(run).where("n > 0").select("doc", "tid", F.col("at").alias("start"), "n"), "repeated-windows")
            gone = part if gone is None else gone.unionByName(part)
            self._add(self.runs[self.WINDOWS], self.runs[self.WINDOWS].pop(), self.WINDOWS)
        for run in new:
            self._add(self.runs[self.ANCHORS], run, self.ANCHORS)
        return gone

    def _told_windows(self, docs: DataFrame, bits) -> str:
        """The windows of documents under the anchors of a filter, told by the earlier window runs, as the last run."""
        rows = docs.mapInArrow(_window_rows(bits), ROWS).repartition(self.buckets, "wh")
        old = F.lit(False)
        check = F.shiftrightunsigned("at", 32)
        for k, r in enumerate(self.runs[self.WINDOWS]):
            rows = rows.join(self._windows(r).select("wh", F.col("check").alias(f"c{k}")), "wh", "left")
            old = old | F.coalesce(F.col(f"c{k}") == check, F.lit(False))
        told = rows.select("wh", "at", "doc", "tid", "n", old.alias("old")).sortWithinPartitions("wh", check, "doc", "tid", "at").mapInArrow(_told, ROWS)
        run = self._write(told, self.WINDOWS)
        self.runs[self.WINDOWS].append(run)
        return run

    def drop(self) -> None:
        """Deletes the index with its files."""
        for names in self.runs.values():
            for name in names:
                self._drop(name)
            names.clear()
        removed(self.spark, self.folder)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, starts, sizes) to (doc_id, n_words, n_removed, kept_text)."""
    for b in chunks(batches):
        texts = b.column("text").cast(pa.binary()).to_pylist()
        starts, sizes = (b.column(c).to_pylist() for c in ("starts", "sizes")) if "starts" in b.schema.names else ([None] * len(texts),) * 2
        n_words, n_removed, kept = [], [], []
        for t, first, size in zip(texts, starts, sizes, strict=True):
            words = (t or b"").split()
            n_words.append(len(words))
            n_removed.append(0)
            if first:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, first, 1)
                np.add.at(edge, np.minimum(np.add(first, size) + WINDOW - 1, len(words)), -1)
                stay = np.cumsum(edge)[:-1] <= 0
                n_removed[-1] = int((~stay).sum())
                words = [words[i] for i in np.flatnonzero(stay)]
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])


def documents(docs: DataFrame) -> DataFrame:
    """(doc, tid, text) of documents (doc_id, text)."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("tid"), text.alias("text"))


def without_repetitions(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one space) of each row of `docs`.

    The documents are ingested in `batches` ranges of doc_id of about equal size.
    """
    docs = documents(docs)
    some = docs.where("doc is not null and text is not null")
    cuts = some.agg(F.percentile_approx("doc", [k / batches for k in range(1, batches)] or [0.5], 1000)).first()[0]
    out = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"
    if cuts is None:
        return docs.mapInArrow(_cut, out)
    bounds = [None, *sorted(set(cuts if batches > 1 else [])), None]
    parts = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        part = some if lo is None else some.where(F.col("doc") > F.lit(lo))
        parts.append(part if hi is None else part.where(F.col("doc") <= F.lit(hi)))
    index = Index(docs.sparkSession)
    try:
        gone = index.ingest(parts)
    finally:
        index.drop()
    touched, whole = parted(docs, "doc", gone.select("doc").distinct())
    # A document's runs are no more than its words, however often its row is repeated.
    runs = gone.groupBy(F.col("doc").alias("d"), F.col("tid").alias("t")).agg(F.collect_set(F.struct("start", "n")).alias("r")).select("d", "t", F.col("r.start").alias("starts"), F.col("r.n").alias("sizes"))
    cut = touched.join(runs, (F.col("doc") == F.col("d")) & (F.col("tid") == F.col("t")), "left").select("doc", "text", "starts", "sizes")
    return cut.mapInArrow(_cut, out).unionByName(whole.mapInArrow(_cut, out))
