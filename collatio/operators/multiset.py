"""Bags of tokens or numbers, and their differences.

A bag is a DataFrame of keys, an item, how often it occurs (n) and where first (first_pos). Items are
counted before they are shuffled; bags of both sides then meet on keys and item in one full join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bag(df: DataFrame, items: Column, keys: Sequence[str], item: str = "token", order: Column | None = None) -> DataFrame:
    """Counts of an array's items by keys. `order` places rows of one key after one another."""
    place = F.col("__pos").cast("long") if order is None else F.struct(order.alias("row"), F.col("__pos").cast("long").alias("pos"))
    return df.select(*keys, *([order.alias("__order")] if order is not None else []), F.posexplode(items).alias("__pos", item)).groupBy(*keys, item).agg(F.count("*").alias("n"), F.min(place if order is None else F.struct(F.col("__order").alias("row"), F.col("__pos").cast("long").alias("pos"))).alias("first_pos"))


def union(*bags: DataFrame, keys: Sequence[str], item: str = "token") -> DataFrame:
    """The bag of all occurrences in several bags."""
    out = bags[0]
    for b in bags[1:]:
        out = out.unionByName(b)
    return out.groupBy(*keys, item).agg(F.sum("n").alias("n"), F.min("first_pos").alias("first_pos"))


def difference(reference: DataFrame, candidate: DataFrame, keys: Sequence[str], item: str = "token") -> DataFrame:
    """keys, item, n_reference, n_candidate, missing, extra and first_pos of every item of either bag."""
    r = reference.select(*keys, item, F.col("n").alias("n_reference"), F.col("first_pos").alias("__r"))
    c = candidate.select(*keys, item, F.col("n").alias("n_candidate"), F.col("first_pos").alias("__c"))
    n_r, n_c = (F.coalesce(x, F.lit(0)) for x in ("n_reference", "n_candidate"))
    return r.join(c, [*keys, item], "full").select(
        *keys, item, n_r.alias("n_reference"), n_c.alias("n_candidate"),
        F.greatest(n_r - n_c, F.lit(0)).alias("missing"), F.greatest(n_c - n_r, F.lit(0)).alias("extra"), F.coalesce("__r", "__c").alias("first_pos"),
    )


def recall(differences: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, total, missing, extra and recall; recall is null where the reference is empty."""
    total = F.sum("n_reference")
    return differences.groupBy(*keys).agg(total.alias("total"), F.sum("missing").alias("missing"), F.sum("extra").alias("extra"), F.when(total > 0, (total - F.sum("missing")) / total).alias("recall"))


def top(differences: DataFrame, what: str, keys: Sequence[str], k: int, item: str = "token") -> DataFrame:
    """The k items with the greatest `what` of each key; of equal ones those that come first, then by name."""
    order = Window.partitionBy(*keys).orderBy(F.desc(what), F.col("first_pos").asc_nulls_last(), item)
    return differences.where(F.col(what) > 0).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def commonest(df: DataFrame, items: Column, keys: Sequence[str], order: str, k: int, item: str = "token") -> DataFrame:
    """keys, item, n and rank of the k commonest items of each key; of equal ones those that come first, then by name.

    Items are counted with the first row (`order`) that has them, which needs no sort; where in its row an item stands is
    looked up only for those that can be among the first k.
    """
    counted = df.select(*keys, order, F.explode(items).alias(item)).groupBy(*keys, item).agg(F.count("*").alias("n"), F.min(order).alias("__first"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.col("__first").asc_nulls_last())
    near = counted.withColumn("__rank", F.rank().over(w)).where(F.col("__rank") <= k).drop("__rank")
    wanted = near.select(F.col("__first").alias(order)).distinct()
    held = df.join(wanted, order, "left_semi").select(*keys, F.col(order).alias("__first"), F.posexplode(items).alias("__pos", item))
    places = held.groupBy(*keys, "__first", item).agg(F.min("__pos").alias("__pos"))
    same = [near[c].eqNullSafe(places[c]) for c in (*keys, "__first", item)]
    found = near.join(places, reduce(and_, same), "left").select(*(near[c] for c in (*keys, item, "n", "__first")), "__pos")
    order_ = Window.partitionBy(*keys).orderBy(F.desc("n"), F.col("__first").asc_nulls_last(), F.col("__pos").asc_nulls_last(), item)
    return found.withColumn("rank", F.row_number().over(order_)).where(F.col("rank") <= k).drop("__first", "__pos")


def first_difference(left: DataFrame, right: DataFrame, keys: Sequence[str], words: str = "words", around: int = 3) -> DataFrame:
    """For keys of both sides whose word arrays differ: the 0-based first place, both words there and some context.

    A side that ends early has a null word.
    """
    both = left.select(*keys, F.col(words).alias("__l")).join(right.select(*keys, F.col(words).alias("__r")), list(keys))
    n = F.greatest(F.size("__l"), F.size("__r"))
    # The arrays are side by side already, so no position needs a shuffle.
    at = F.array_min(F.filter(F.transform(F.arrays_zip("__l", "__r"), lambda p, i: F.when(~p["__l"].eqNullSafe(p["__r"]), i)), lambda i: i.isNotNull()))
    found = both.withColumn("position", at).where("position is not null").withColumn("n", n)
    piece = lambda a: F.array_join(F.slice(a, F.greatest(F.col("position") - around, F.lit(0)) + 1, F.least(F.col("position"), F.lit(around)) + around + 1), " ")
    return found.select(*keys, F.col("position").cast("long").alias("position"), F.get("__l", "position").alias("left_word"), F.get("__r", "position").alias("right_word"), piece(F.col("__l")).alias("left_context"), piece(F.col("__r")).alias("right_context"))


def only_left(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of the left side that the right one hasn't."""
    return left.select(*on).distinct().join(right.select(*on), list(on), "left_anti")


def within(df: DataFrame, reference: Column, candidate: Column, keys: Sequence[str], without: Column | None = None) -> DataFrame:
    """keys, total, missing and extra of each row, whose two lists of items are compared as bags within the row.

    Items of `without` are taken out of the candidate's, which has to hold them.

    The sorted items of both sides, each with a sign, are summed up by runs, so nothing is shuffled and no side is searched.
    """
    sign = lambda c, n: F.transform(c, lambda x: F.struct(x.alias("x"), F.lit(n).alias("n")))
    both = F.array_sort(F.concat(sign(reference, 1), sign(candidate, -1), *([] if without is None else [sign(without, 1)])))
    start = F.struct(F.lit(None).cast("string").alias("x"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("missing"), F.lit(0).cast("long").alias("extra"))

    def step(a: Column, c: Column) -> Column:
        same = a["x"].eqNullSafe(c["x"])
        return F.struct(
            c["x"].alias("x"), F.when(same, a["n"] + c["n"]).otherwise(c["n"]).cast("long").alias("n"),
            F.when(same, a["missing"]).otherwise(a["missing"] + F.greatest(a["n"], F.lit(0))).cast("long").alias("missing"), F.when(same, a["extra"]).otherwise(a["extra"] + F.greatest(-a["n"], F.lit(0))).cast("long").alias("extra"),
        )

    done = F.aggregate("__both", start, step, lambda a: F.struct((a["missing"] + F.greatest(a["n"], F.lit(0))).alias("missing"), (a["extra"] + F.greatest(-a["n"], F.lit(0))).alias("extra")))
    rows = df.select(*keys, F.size(reference).cast("long").alias("total"), both.alias("__both"))
    return rows.select(*keys, "total", done.alias("__d")).select(*keys, "total", "__d.missing", "__d.extra")


def numbered(df: DataFrame, order: Sequence[str], coarse: Sequence[str], name: str) -> DataFrame:
    """Rows with their place, from 1, in an order that begins with the `coarse` columns; no task sees all rows.

    Rows are counted by the coarse columns; sums of the counts and places within each give the place.
    """
    counts = df.groupBy(*coarse).agg(F.count("*").alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy(*coarse).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    inside = F.row_number().over(Window.partitionBy(*coarse).orderBy(*order))
    return df.withColumn("__inside", inside).join(before, list(coarse)).withColumn(name, F.col("__before") + F.col("__inside")).drop("__before", "__inside")


def set_difference(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that only one side has, with the side."""
    return only_left(left, right, on).withColumn("side", F.lit("left")).unionByName(only_left(right, left, on).withColumn("side", F.lit("right")))


#: Up to so many keys are sent to where the rows are; more meet them in a shuffle.
FEW = 200_000


def among(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose key `wanted` has. If it has few keys, which are counted first, no row is shuffled."""
    keys = wanted.select(key).distinct()
    return rows.join(F.broadcast(keys) if keys.limit(FEW + 1).count() <= FEW else keys, key, "left_semi")


def strided(df: DataFrame, order: Sequence[str], step: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Every step-th row of each key, from the first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__row", F.row_number().over(w) - 1).where(F.col("__row") % step == 0).drop("__row")


def strided_whole(df: DataFrame, order: str, step: int) -> DataFrame:
    """Every step-th row of a whole table, from the first; rows are numbered within ranges of `order`, so no task sees all."""
    width = df.select(F.min(order).cast("double").alias("lo"), F.max(order).cast("double").alias("hi"), F.count("*").alias("n"))
    ranges = df.crossJoin(F.broadcast(width)).withColumn("__range", F.least(F.lit(1023), F.floor((F.col(order).cast("double") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1.0)) * 1024)).cast("long")).drop("lo", "hi", "n")
    before = ranges.groupBy("__range").agg(F.count("*").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    w = Window.partitionBy("__range").orderBy(order)
    return ranges.join(F.broadcast(before), "__range").withColumn("__row", F.col("__before") + F.row_number().over(w) - 1).where(F.col("__row") % step == 0).drop("__range", "__before", "__row")
