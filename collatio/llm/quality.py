"""Quality rules: a ledger of measurements and failure bits, and policies read from it.

`ledger` evaluates every rule once per document and keeps the measurements beside one bit per
failed rule. A policy is a versioned set of rules, so applying, comparing or ablating policies
is integer arithmetic on the bits; texts are never read again.

Text null or without words: all measurements 0, which fails `few_words`. Ids aren't read, so null and
repeated ones are rows like others; an empty table gives an empty ledger. Repeated documents get one row each. Very long texts are measured whole. Columns of the input that are named like a
measurement are replaced by it in `ledger(..., keep=...)` output only if not in `keep`.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.llm.staging import small_batches
from collatio.llm.words import Words, alike, byte_hashes, chunks, mix, per_document

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_unspaced")

#: Name, and the SQL condition under which a document fails; the position is the bit.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("many_symbols", "5 * n_symbols > n_words"),
    ("duplicate_lines", "n_lines >= 5 and 100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars - n_unspaced > 20 * n_words and 2 * n_unspaced < word_chars"),
    ("shouting", "100 * n_upper > 60 * n_letters and n_words >= 20"),
)
BASE = ("few_words", "repeated_words")
#: Policies by version; later versions never change what an earlier one means.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "many_symbols", "duplicate_lines", "short_words", "long_words", "shouting"),
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
#: Scripts written without blanks, and their punctuation.
_UNSPACED = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x3000, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFE30, 0xFE4F), (0xFF00, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
)
_kinds: list[np.ndarray] = []


def _kind() -> np.ndarray:
    """For each code point: 1 if it is a letter, 2 if an upper-case one, 4 if of a script without blanks, added up."""
    if not _kinds:
        names = (unicodedata.category(chr(i)) for i in range(0x110000))
        kind = np.fromiter(((3 if c in ("Lu", "Lt") else 1) if c[0] == "L" else 0 for c in names), np.uint8, 0x110000)
        for lo, hi in _UNSPACED:
            kind[lo : hi + 1] |= 4
        _kinds.append(kind)
    return _kinds[0]


def _beyond_ascii(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters of several bytes begin in UTF-8, and their kinds."""
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at].astype(np.int64)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & (0x7F >> size)
    for k in (1, 2, 3):
        more = size > k
        point[more] = point[more] << 6 | (data[at[more] + k] & 0x3F)
    return at, _kind()[point]


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of each text of a column."""
    w = Words(column)
    lead = (w.data & 0xC0) != 0x80
    upper, letter, unspaced = _UPPER[w.data], _LETTER[w.data], np.zeros(len(w.data), bool)
    at, kind = _beyond_ascii(w.data)
    letter[at], upper[at], unspaced[at] = kind & 1 > 0, kind & 2 > 0, kind & 4 > 0
    out = {
        "n_words": w.counts,
        "word_chars": per_document(lead & ~w.space, w.offsets),
        "n_symbols": per_document(_SYMBOL[w.data], w.offsets),
        "n_upper": per_document(upper, w.offsets),
        "n_letters": per_document(letter, w.offsets),
        "n_unspaced": per_document(unspaced, w.offsets),
    }
    n = len(column)
    # Lines: from each document's start, and from after each \n. Those without a word don't count.
    breaks = np.flatnonzero(w.data == 10)
    begin = np.sort(np.concatenate([w.offsets[:-1], breaks + 1]), kind="stable")
    stop = np.sort(np.concatenate([w.offsets[1:], breaks]), kind="stable")
    doc = np.searchsorted(w.offsets[:-1], np.sort(np.concatenate([w.offsets[:-1], breaks])), side="right") - 1
    ok = np.searchsorted(w.start, begin) < np.searchsorted(w.start, stop)
    begin, stop, doc = begin[ok], stop[ok], doc[ok]
    out["n_lines"] = np.bincount(doc, minlength=n)
    own = lambda x, doc: x ^ mix(doc.astype(np.uint64) + np.uint64(1))
    one, two = byte_hashes(w.data, begin, stop)
    _, once = np.unique(alike(own(one, doc), two), return_index=True)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(doc[once], minlength=n)
    # Windows that occur twice in their document cover words.
    at, one, two = w.windows(WINDOW, *w.hashes())
    docs = w.documents()
    covered = np.zeros(len(w.start) + 1, np.int64)
    if len(at):
        h = alike(own(one, docs[at]), two)
        order = np.argsort(h, kind="stable")
        s = h[order]
        same = s[1:] == s[:-1]
        twice = np.zeros(len(s), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = at[order[twice]]
        covered[: len(w.start)] += np.bincount(hit, minlength=len(w.start))[: len(w.start)]
        covered -= np.bincount(hit + WINDOW, minlength=len(w.start) + 1)[: len(w.start) + 1]
    out["n_repeat_words"] = per_document(np.cumsum(covered)[:-1] > 0, w.first)
    return out


def measurements(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep` of each row with the measurements of its text."""
    names = [c for c in keep if c not in MEASURES]
    small_batches(docs.sparkSession)
    source = docs.select(*names, F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "__text"):
            found = measure(b.column("__text"))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *(pa.array(found[m].astype(np.int64)) for m in MEASURES)], names=[*names, *MEASURES])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in names), *(f"{m} bigint" for m in MEASURES)])
    return source.mapInArrow(run, schema)


def bit(rule: str) -> int:
    return 1 << [name for name, _ in RULES].index(rule)


def mask(rules: Sequence[str]) -> int:
    return sum({bit(r) for r in rules})


def failure_bits() -> Column:
    """One bit for each rule of RULES that the measurements of a row fail."""
    return sum((F.when(F.expr(cond), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, cond) in enumerate(RULES)), F.lit(0)).cast("long")


def ledger(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`keep`, the measurements and `failed_bits` of each document."""
    return measurements(docs, text, keep).withColumn("failed_bits", failure_bits())


def passes(policy: str, bits: str = "failed_bits") -> Column:
    """Whether a ledger row passes every rule of a policy."""
    return F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(book: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that the policy without it keeps.

    The bits are counted first, so that what is shuffled is a row for each distinct set of failures and task.
    """
    whole = mask(POLICIES[policy])
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("bit")) for r in POLICIES[policy]))
    b = F.col("failed_bits").bitwiseAND(F.lit(whole))
    return (
        book.groupBy(b.alias("b")).agg(F.count("*").alias("n"))
        .select("b", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("b").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("b") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(F.col("b").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
        )
    )


def kept_documents(docs: DataFrame, policy: str = "v1", text: str = "text") -> DataFrame:
    """The rows of `docs` that pass a policy, with their own columns and no others."""
    names = docs.columns
    own = {c: f"__c{k}" for k, c in enumerate(names)}
    renamed = docs.select(*(F.col(f"`{c}`").alias(own[c]) for c in names))
    book = ledger(renamed, own[text], keep=tuple(own.values()))
    return book.where(passes(policy)).select(*(F.col(own[c]).alias(c) for c in names))
