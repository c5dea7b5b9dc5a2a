"""Aggregates whose ties and definitions follow the data's order, and de-duplication that keeps the first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
DEFAULT_MODE, DEFAULT_MEDIAN, MIN_REPEATS = 12.0, 10.0, 3
HEADER_SHARE, ZONE_PAD, CLUSTER_GAP = 0.5, 0.01, 0.01


def first_seen_mode(df: DataFrame, value: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, mode and n: the commonest value, of equally common ones the one seen first."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = F.max_by(F.struct(F.col(value).alias("mode"), "n"), F.struct(F.col("n"), -F.col("first"))) if not keys else None
    if best is not None:
        return counted.agg(best.alias("b")).select("b.*")
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), "first")
    return counted.withColumn("__r", F.row_number().over(w)).where("__r = 1").select(*keys, F.col(value).alias("mode"), "n")


def upper_median(df: DataFrame, value: str, keys: Sequence[str], default: float = DEFAULT_MEDIAN) -> DataFrame:
    """keys and upper_median: the value at place n // 2 of the sorted ones.

    The rank comes from counts of distinct values, so no group is gathered into one row.
    """
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*keys)
    upto = F.sum(F.when(F.col(value).isNotNull(), F.col("__n")).otherwise(0)).over(w.orderBy(F.col(value).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(F.when(F.col(value).isNotNull(), F.col("__n")).otherwise(0)).over(w)
    return counted.withColumn("__upto", upto).withColumn("__total", total).groupBy(*keys).agg(F.coalesce(F.min(F.when(F.col("__upto") > F.floor(F.col("__total") / 2), F.col(value))), F.lit(default)).alias("upper_median"))


def median(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """keys and median: of the sorted values the middle one, or the mean of the two in the middle, from counts of distinct values."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*keys)
    ranked = counted.withColumn("__upto", F.sum("__n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))).withColumn("__total", F.sum("__n").over(w))
    at = lambda place: F.min(F.when(F.col("__upto") > place, F.col(value)))
    low, high = at(F.floor((F.col("__total") - 1) / 2)), at(F.floor(F.col("__total") / 2))
    found = ranked.groupBy(*keys).agg(((low.cast("double") + high.cast("double")) / 2).alias("median"))
    # Groups of nulls alone have no median.
    return df.select(*keys).distinct().join(found, list(keys), "left") if keys else found


def recurring(df: DataFrame, key: Column, unit: str, at_least: int = MIN_REPEATS, name: str = "key") -> DataFrame:
    """Keys that come up in several units, with the number of units."""
    return df.select(key.alias(name), unit).distinct().groupBy(name).agg(F.count("*").alias("n_units")).where(F.col("n_units") >= at_least)


def recurring_reasons(df: DataFrame, key: str, unit: str, only_known: Mapping[str, bool], known: str | None = None, keys: Sequence[str] = (), at_least: int = MIN_REPEATS) -> DataFrame:
    """keys, reason and n of rows (key, unit, reason), of which some reasons count only in keys that come up in several units (True) or only in others (False where `known` is given).

    `known` is the reason of all rows of such keys. Rows are counted by key and unit and then by key, so those of a
    frequent key are few before they come together.
    """
    reasons = list(only_known)
    each = [F.count_if(F.col("reason") == r).alias(f"__n{i}") for i, r in enumerate(reasons)]
    sums = lambda *names: [F.sum(n).alias(n) for n in names]
    names = [f"__n{i}" for i in range(len(reasons))]
    units = df.groupBy(key, unit, *keys).agg(*each, F.count("*").alias("__all"))
    counts = units.groupBy(key, *keys).agg(F.count(unit).alias("__units"), *sums(*names, "__all"))
    several = (F.sum("__units").over(Window.partitionBy(key)) if keys else F.col("__units")) >= at_least
    counts = counts.withColumn("__several", several)
    taken = [F.when(F.col("__several"), F.col(n)).otherwise(0) if only_known[r] else F.when(~F.col("__several"), F.col(n)).otherwise(0) if known else F.col(n) for n, r in zip(names, reasons, strict=True)]
    found = [F.struct(F.lit(r).alias("reason"), F.sum(t).alias("n")) for r, t in zip(reasons, taken, strict=True)]
    found += [F.struct(F.lit(known).alias("reason"), F.sum(F.when(F.col("__several"), F.col("__all")).otherwise(0)).alias("n"))] if known else []
    rows = counts.groupBy(*keys).agg(F.array(*found).alias("__found"))
    return rows.select(*keys, F.explode("__found").alias("__f")).select(*keys, "__f.reason", "__f.n").where("n > 0")


def edge_cluster(df: DataFrame, keys: Sequence[str], top: str, bottom: str, order: str, gap: float = CLUSTER_GAP) -> DataFrame:
    """keys and extent: how far the intervals that hang together from the first one reach, before a gap over `gap`."""
    w = Window.partitionBy(*keys).orderBy(top, order)
    reached = F.max(bottom).over(w.rowsBetween(Window.unboundedPreceding, -1))
    broken = F.sum(F.when(F.col(top) - F.col("__reached") > gap, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("__reached", reached).withColumn("__broken", broken).where("__broken = 0").groupBy(*keys).agg(F.max(bottom).alias("extent"))


def first_of_key(df: DataFrame, key: str, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows without a key, and of those with one the first of each."""
    w = Window.partitionBy(*keys, key).orderBy(*order)
    return df.withColumn("__r", F.when(F.coalesce(F.col(key), F.lit("")) == "", F.lit(1)).otherwise(F.row_number().over(w))).where("__r = 1").drop("__r")


def duplicates(df: DataFrame, digest: Column, label: str) -> DataFrame:
    """label, digest and same_as of the rows whose content an earlier label has.

    The first labels are aggregated before they meet the rows, so a digest that very many rows share is a
    skewed join, which can be split, and not a group in one task.
    """
    rows = df.select(label, digest.alias("digest"))
    firsts = rows.groupBy("digest").agg(F.min(label).alias("same_as"))
    return rows.join(firsts, "digest").where(F.col(label) != F.col("same_as")).select(label, "digest", "same_as")


def repeated_names(df: DataFrame, slug: Column, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """`df` with name: the slug, and -cont2, -cont3 and so on behind the later ones of equal slugs."""
    w = Window.partitionBy(*keys, "__slug").orderBy(order)
    return df.withColumn("__slug", slug).withColumn("__n", F.row_number().over(w)).withColumn("name", F.when(F.col("__n") == 1, F.col("__slug")).otherwise(F.concat("__slug", F.lit("-cont"), F.col("__n").cast("string")))).drop("__slug", "__n")


def consistent_offset(df: DataFrame, left: str, right: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, n_offsets and offset: the one difference between two columns, or null if it varies."""
    d = F.col(left) - F.col(right)
    return df.groupBy(*keys).agg(F.count_distinct(d).alias("n_offsets"), F.when(F.count_distinct(d) == 1, F.max(d)).alias("offset"))


def share(df: DataFrame, condition: Column, keys: Sequence[str], name: str = "share") -> DataFrame:
    """The share of rows that meet a condition, and their number."""
    return df.groupBy(*keys).agg(F.count_if(condition).alias("n"), (F.count_if(condition) / F.count("*")).alias(name))


def bbox_union(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The smallest boxes around the boxes x0, y0, x1, y1 of each key."""
    return df.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def furniture(lines: DataFrame, body_digits: int = 1) -> DataFrame:
    """book_id, header_zone, folio_zone, boilerplate_keys and body_size of lines (book_id, page, line_no, text, size, y0, y1, page_height).

    One aggregation of the book's lines each: the median reach of what hangs together from the page's top,
    the least height of bare page numbers, and masked texts that recur low on the page.
    """
    from collatio.functions.kernel import FOLIO, mask, strip

    rel = lines.withColumn("top", F.col("y0") / F.col("page_height")).withColumn("bottom", F.col("y1") / F.col("page_height")).withColumn("folio", strip(F.col("text")).rlike(FOLIO))
    pages = rel.groupBy("book_id").agg(F.count_distinct("page").alias("n_pages"))
    reach = edge_cluster(rel.where("top < 0.22"), ["book_id", "page"], "top", "bottom", "line_no")
    head = reach.groupBy("book_id").agg(F.median("extent").alias("mid"), F.count("*").alias("n_reach"))
    foot = rel.where("bottom > 0.78 and folio").groupBy("book_id", "page").agg(F.min("top").alias("low")).groupBy("book_id").agg(F.min("low").alias("low"), F.count("*").alias("n_folio"))
    keys = rel.where("top > 0.75").select("book_id", "page", mask(F.col("text")).alias("key")).distinct().groupBy("book_id", "key").agg(F.count("*").alias("n")).where((F.col("n") >= MIN_REPEATS) & ~F.col("key").rlike(FOLIO))
    boiler = keys.groupBy("book_id").agg(F.array_sort(F.collect_set("key")).alias("boilerplate_keys"))
    sizes = first_seen_mode(rel.withColumn("s", F.round("size", body_digits)).withColumn("place", F.col("page") * 100000 + F.col("line_no")), "s", "place", ["book_id"])
    return (
        pages.join(head, "book_id", "left").join(foot, "book_id", "left").join(boiler, "book_id", "left").join(sizes.select("book_id", F.col("mode").alias("body_size")), "book_id", "left")
        .select(
            "book_id",
            F.when(F.coalesce("n_reach", F.lit(0)) / F.col("n_pages") >= HEADER_SHARE, F.col("mid") + ZONE_PAD).otherwise(0.0).alias("header_zone"),
            F.when(F.coalesce("n_folio", F.lit(0)) >= MIN_REPEATS, F.col("low") - ZONE_PAD).otherwise(1.0).alias("folio_zone"),
            F.coalesce("boilerplate_keys", F.array().cast("array<string>")).alias("boilerplate_keys"),
            F.coalesce("body_size", F.lit(DEFAULT_MODE)).alias("body_size"),
        )
    )


def furniture_reason(text: Column, y0: Column, size: Column, body: Column, height: Column, header_zone: Column, folio_zone: Column, keys: Column) -> Column:
    """Why a line is furniture, the first reason of four, or null."""
    from collatio.functions.kernel import FOLIO, display_heading_size, mask, strip

    top = y0 / height
    return (
        F.when(size >= display_heading_size(body), "display_heading")
        .when((header_zone > 0) & (top < header_zone), "running_header")
        .when((top > folio_zone) & strip(text).rlike(FOLIO), "page_folio")
        .when((top > 0.75) & (size < body - 0.5) & F.array_contains(keys, mask(text)), "footer_boilerplate")
    )
