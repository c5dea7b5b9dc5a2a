"""Mixing sources to target weights, by cutting a hash-random order at each source's exact budget.

Every document gets a random key (a hash of its id). The keys of a source are dealt to ranges of
keys, a prefix sum over the ranges' totals and one within each range give the words before each
document, and the source's budget is cut at exactly that many words; a budget over the source's
size takes all of it for each whole epoch first. No range holds a hot source: a source has one range
for each `ROWS_PER_RANGE` rows, `MAX_RANGES` at most, so the sum over ranges is short, too.

Only DataFrame functions run. Null texts have size 0; sources of size 0 get target 0; a null source
is a source of its own, the last; repeated rows are documents of their own; an empty table gives an
empty mix. Null ids share one key and are told apart by size. Other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collatio.llm.staging import staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
ROWS_PER_RANGE = 64
MAX_RANGES = 4096
#: Source tables up to this many rows are broadcast; larger ones are joined by shuffling.
BROADCAST_ROWS = 10_000
#: Sources are few, such as sites or crawls: their table is sorted and summed in one task, and no more than these are taken.
MOST_SOURCES = 1_000_000

_SPACE = r"\x20\x09-\x0D"


def words(text: Column) -> Column:
    """The number of words: runs outside space, tab, \\n, \\v, \\f, \\r."""
    inner = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", 0).otherwise(F.length(F.regexp_replace(inner, f"[^{_SPACE}]++[{_SPACE}]*+", "x"))).cast("long")


def random_key(doc_id: Column) -> Column:
    """60 bits of the id's MD5, so that any engine can draw the same order."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, n_rows) to (sid, source, source_size, n_rows, target).

    Weights repeat over the sources by code point, null last. What a source can't take, `epochs`
    times its size, is shared again by weight: with the sources by cap over weight, the level is that
    of the first which stays below its cap once all before it are full.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("reach", "sid")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int")).cast("double")
    return (
        sizes.withColumn("sid", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size").cast("double") * epochs)
        .withColumn("reach", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(every).cast("double") * share)
        .withColumn("full", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("full")) / F.col("rest"))
        .withColumn("at", F.min(F.when(F.col("reach") > F.col("level"), F.struct("reach", "sid", "level"))).over(every)["level"])
        .withColumn("target", F.coalesce(F.least("cap", F.col("weight") * F.col("at")), F.col("cap")))
        .select("sid", "source", "source_size", "n_rows", "target")
    )


def mix(docs: DataFrame, key: Column | None = None, keep: tuple[str, ...] = ("doc_id",), text: str = "text", source: str = "source", **shares) -> DataFrame:
    """`keep`, size, source_size, target and taken of each row of `docs`.

    taken is size for each epoch that the mix takes whole, and what the cut leaves in the last one.
    `shares`: weights, share and epochs of `targets`.
    """
    key = random_key(F.col("doc_id")) if key is None else key
    own = {c: f"__{k}" for k, c in enumerate(keep)}
    sized = staged(docs.select(*(F.col(f"`{c}`").alias(own[c]) for c in keep), F.col(f"`{source}`").alias("source"), words(F.col(f"`{text}`")).alias("size"), key.alias("key")), "mix-sizes")
    sums = staged(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")), "mix-sources")
    n_sources = sums.count()
    if n_sources > MOST_SOURCES:
        raise ValueError(f"{n_sources} sources; weights are shared among {MOST_SOURCES} at most")
    per_source = staged(targets(sums, **shares), "mix-targets")
    small = n_sources <= BROADCAST_ROWS
    goals = (F.broadcast(per_source) if small else per_source).withColumnRenamed("source", "s")
    ranges = F.least(F.lit(MAX_RANGES), F.ceil(F.col("n_rows") / ROWS_PER_RANGE)).cast("long")
    rows = sized.join(goals, F.col("source").eqNullSafe(F.col("s")), "inner").drop("s").withColumn("range", F.shiftright(F.shiftright("key", 30) * ranges, 30))
    before_range = (
        rows.groupBy("sid", "range").agg(F.sum("size").alias("range_size"))
        .withColumn("before", F.coalesce(F.sum("range_size").over(Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("sid", "range", "before")
    )
    inside = Window.partitionBy("sid", "range").orderBy("key", *own.values(), "size").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target")).cast("long")).otherwise(0)
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    left = whole - epochs * F.col("source_size") - F.col("before") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    return (
        rows.join(before_range, ["sid", "range"])
        .withColumn("whole_epochs", epochs)
        .withColumn("cut_words", F.greatest(F.lit(0), F.least(F.col("size"), left)))
        .withColumn("taken", F.col("whole_epochs") * F.col("size") + F.col("cut_words"))
        .select(*(F.col(own[c]).alias(c) for c in keep), "source", "size", "source_size", "target", "whole_epochs", "cut_words", "taken")
    )


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its n-th word."""
    ends = F.regexp_extract_all(text, F.lit(f"[{_SPACE}]*+[^{_SPACE}]++"), F.lit(0))
    return F.array_join(F.slice(ends, F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, **shares) -> DataFrame:
    """The documents of the mix: each as often as it is taken whole, and once more if its last words are, cut there.

    One document of a source at most is cut. n_chars, if there, follows the text. The rows need a
    `doc_id`, `text` and `source`; texts travel through the plan's join once, by id and content. Null texts
    and such without a word are there once for each whole epoch of their source; nulls, repeated rows and other
    columns stay as they are, and an empty table gives an empty mix.
    """
    names = docs.columns
    own = ["__k", "__mark"]
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__k")
    marked = docs.select("*", known, F.xxhash64("doc_id", "text", "source").alias("__mark"))
    plan = mix(marked, keep=("doc_id", "__mark"), **shares)
    # Equal rows follow one another in a source's order, so the cut leaves them all alike but in one group of a source at most.
    counted = plan.groupBy(known, "__mark", "size", "whole_epochs", "cut_words").agg(F.count("*").alias("n"))
    plans = staged(counted.groupBy(*own).agg(F.first("size").alias("__size"), F.first("whole_epochs").alias("__epochs"), F.sort_array(F.collect_list(F.struct("cut_words", "n"))).alias("__cuts")), "mix-plans")
    alike, torn = plans.where("size(__cuts) = 1"), staged(plans.where("size(__cuts) > 1"), "mix-torn")
    both = marked.join(alike, own).withColumn("__cut", F.col("__cuts")[0]["cut_words"])
    n_torn = torn.count()
    if n_torn:
        # The rows of a torn group are numbered within the pieces that they are written in, so that no task has all of them.
        rows = marked.join(F.broadcast(torn) if n_torn <= BROADCAST_ROWS else torn, own).withColumn("__m", F.monotonically_increasing_id())
        rows = staged(rows, "mix-torn-rows").withColumn("__piece", F.shiftright("__m", 33))
        before = rows.groupBy(*own, "__piece").agg(F.count("*").alias("__rows")).withColumn("__before", F.coalesce(F.sum("__rows").over(Window.partitionBy(*own).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__rows")
        rank = F.col("__before") + F.row_number().over(Window.partitionBy(*own, "__piece").orderBy("__m")) - 1
        cut = F.aggregate("__cuts", F.struct(F.col("__rank").alias("left"), F.lit(0).cast("long").alias("cut")), lambda a, c: F.struct((a["left"] - c["n"]).alias("left"), F.when(a["left"] >= 0, c["cut_words"]).otherwise(a["cut"]).alias("cut")), lambda a: a["cut"])
        numbered = rows.join(before, [*own, "__piece"]).withColumn("__rank", rank).withColumn("__cut", cut)
        both = both.unionByName(numbered.select(*both.columns))
    pieces = F.concat(F.array_repeat(F.col("__size"), F.col("__epochs").cast("int")), F.when(F.col("__cut") > 0, F.array("__cut")).otherwise(F.array().cast("array<bigint>")))
    taken = both.withColumn("__words", F.explode(pieces))
    text = F.when(F.col("__words") < F.col("__size"), first_words(F.col("text"), F.col("__words"))).otherwise(F.col("text"))
    changed = {"text": text} | ({"n_chars": F.when(F.col("__words") < F.col("__size"), F.length(text).cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in names else {})
    return taken.select(*(changed.get(c, F.col(f"`{c}`")).alias(c) for c in names))
