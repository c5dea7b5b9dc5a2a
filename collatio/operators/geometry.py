"""Spatial predicates and joins over boxes x0, y0, x1, y1.

Joins always have an equality (the page, say); within it boxes meet by bands of their height, so a
page's boxes are compared with their neighbours rather than with all others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOX = ("x0", "y0", "x1", "y1")
BAND = 64.0


def box(prefix: str = "") -> list[Column]:
    return [F.col(prefix + c) for c in BOX]


def area(b: Sequence[Column]) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0.0)) * F.greatest(b[3] - b[1], F.lit(0.0))


def intersection(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return area([F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])])


def overlap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """The share of the smaller box that the two have in common."""
    smaller = F.least(area(a), area(b))
    return intersection(a, b) / F.when(smaller > 0, smaller).otherwise(1.0)


def vertical_overlap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """The share of the lower of two lines that lies beside the other."""
    shorter = F.least(a[3] - a[1], b[3] - b[1])
    return F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0)) / F.when(shorter > 0, shorter).otherwise(1.0)


def contains(outer: Sequence[Column], inner: Sequence[Column], slack: float = 2.0) -> Column:
    return (inner[0] >= outer[0] - slack) & (inner[1] >= outer[1] - slack) & (inner[2] <= outer[2] + slack) & (inner[3] <= outer[3] + slack)


def is_rule(b: Sequence[Column]) -> Column:
    """A box as thin as a printed rule."""
    short, long = F.least(b[2] - b[0], b[3] - b[1]), F.greatest(b[2] - b[0], b[3] - b[1])
    return ((short < 12) & (long > 12 * short)) | ((short < 15) & (long > 25 * short))


def asset_issue(b: Sequence[Column], page: Sequence[Column], pad: float = 4.0, least: float = 24.0) -> Column:
    """Why a box can't be an asset: it is missing, or too small with its padding within the page."""
    w = F.least(b[2] + pad, page[2]) - F.greatest(b[0] - pad, page[0])
    h = F.least(b[3] + pad, page[3]) - F.greatest(b[1] - pad, page[1])
    return F.when(b[0].isNull(), "no_bbox").when((w < least) | (h < least), "too_small")


def touching(left: DataFrame, right: DataFrame, keys: Sequence[str], reach: float = 0.0) -> DataFrame:
    """Pairs of boxes with equal keys that share a band of height, once each; the right side's columns get the prefix r_.

    Both sides need an `id` that is unique within the keys.
    """
    def banded(df: DataFrame, more: float) -> DataFrame:
        lo, hi = (F.floor((F.col(c) + d) / BAND).cast("long") for c, d in (("y0", -more), ("y1", more)))
        return df.withColumn("band", F.explode(F.sequence(lo, F.greatest(lo, hi))))

    r = right.select(*keys, *(F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys)).withColumn("y0", F.col("r_y0")).withColumn("y1", F.col("r_y1"))
    pairs = banded(left, reach).join(banded(r, 0.0).drop("y0", "y1").withColumnRenamed("band", "r_band"), list(keys)).where("band = r_band")
    # The pair counts in the first band that both have.
    first = F.greatest(F.floor((F.col("y0") - reach) / BAND), F.floor(F.col("r_y0") / BAND))
    return pairs.where(F.col("band") == first).drop("band", "r_band")


def distinct_boxes(boxes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Boxes at different places, each with the first of its ids."""
    return boxes.groupBy(*keys, *BOX).agg(F.min("id").alias("id"))


def overlapping(left: DataFrame, right: DataFrame, keys: Sequence[str], over: float) -> DataFrame:
    """Pairs whose overlap exceeds `over`, with it as `score`."""
    return touching(left, right, keys).withColumn("score", overlap(box(), box("r_"))).where(F.col("score") > over)


def overlapping_ids(left: DataFrame, right: DataFrame, keys: Sequence[str], over: float, score: Callable[[Column], Column] = lambda s: s) -> DataFrame:
    """The same pairs by id: keys, id, r_id and score. Boxes at one place are compared once and told apart behind it."""
    places = right.groupBy(*keys, *BOX).agg(F.min("id").alias("id"), F.collect_list("id").alias("ids"))
    pairs = overlapping(left.select(*keys, "id", *BOX), places, keys, over)
    return pairs.select(*keys, "id", score(F.col("score")).alias("score"), "r_ids").select(*keys, "id", F.explode("r_ids").alias("r_id"), "score")


def interior(lines: DataFrame, boxes: DataFrame, keys: Sequence[str], over: float = 0.6) -> DataFrame:
    """Lines inside a box by more than `over` of the smaller one."""
    return lines.join(overlapping(lines, boxes, keys, over).select(*keys, "id").distinct(), [*keys, "id"], "left_semi")


def outside(left: DataFrame, right: DataFrame, keys: Sequence[str], over: float) -> DataFrame:
    """Boxes that no other box covers by more than `over`."""
    return left.join(overlapping(left, right, keys, over).select(*keys, "id").distinct(), [*keys, "id"], "left_anti")


def enclosed(lines: DataFrame, boxes: DataFrame, keys: Sequence[str], slack: float = 2.0) -> DataFrame:
    """Lines within a box, give or take `slack`."""
    floor = lambda c: F.floor(c / BAND).cast("long")
    lo, hi = floor(F.col("y0") - slack), floor(F.col("y1") + slack)
    # A line's top lies in one band, and a box stands in all bands where the top of a line within it may lie.
    places = boxes.select(*keys, *BOX).distinct().withColumn("__band", F.explode(F.sequence(lo, F.greatest(lo, hi))))
    places = places.select(*(F.col(c).alias(f"r_{c}") for c in (*keys, *BOX, "__band")))
    same = [F.col(k) == F.col(f"r_{k}") for k in keys]
    met = reduce(and_, [*same, F.col("__band") == F.col("r___band"), contains(box("r_"), box(), slack)])
    return lines.withColumn("__band", floor(F.col("y0"))).join(places, met, "left_semi").drop("__band")


def best(pairs: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first pair of each left box."""
    w = Window.partitionBy(*keys, "id").orderBy(*order)
    return pairs.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def owner(lines: DataFrame, boxes: DataFrame, keys: Sequence[str], over: float = 0.5) -> DataFrame:
    """Each line's box of greatest overlap, the first of equal ones; of boxes at one place the first stands for all."""
    return best(overlapping(lines, distinct_boxes(boxes, keys), keys, over), keys, [F.desc("score"), F.col("r_id")])


def smallest_container(lines: DataFrame, boxes: DataFrame, keys: Sequence[str], over: float = 0.5) -> DataFrame:
    """Each line's smallest box that it overlaps."""
    return best(overlapping(lines, boxes, keys, over), keys, [area(box("r_")), F.col("r_id")])


def nearest(points: DataFrame, centres: DataFrame, keys: Sequence[str], at: str = "x", within: float = 26.0) -> DataFrame:
    """Each point's nearest centre (column, centre) that is less than `within` away, the first of equally near ones.

    The nearest one is the last centre before the point or the first one behind it, so places, each once, are sorted with
    the centres and no point is compared with all centres around it.
    """
    spot = F.col(at).cast("double").alias("__v")
    ends = centres.where(F.col("centre").isNotNull() & ~F.isnan("centre")).groupBy(*keys, F.col("centre").cast("double").alias("__v")).agg(F.min("column").alias("__c"))
    places = points.where(F.col(at).isNotNull() & ~F.isnan(at)).select(*keys, spot).distinct().withColumn("__c", F.lit(None).cast(ends.schema["__c"].dataType))
    w = Window.partitionBy(*keys).orderBy("__v")
    mark = F.when(F.col("__c").isNotNull(), F.struct(F.col("__v").alias("centre"), F.col("__c").alias("column")))
    before, behind = F.last(mark, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0)), F.last(mark, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(F.desc("__v")).rangeBetween(Window.unboundedPreceding, 0))
    far = lambda c: F.struct(F.abs(F.col("__v") - c["centre"]).alias("distance"), c["column"].alias("column"), c["centre"].alias("centre"))
    found = ends.unionByName(places).withColumn("__b", before).withColumn("__f", behind).where("__c is null")
    near = F.array_min(F.filter(F.array(F.when(F.col("__b").isNotNull(), far(F.col("__b"))), F.when(F.col("__f").isNotNull(), far(F.col("__f")))), lambda x: x.isNotNull() & (x["distance"] < within)))
    found = found.select(*keys, "__v", near.alias("__n")).where("__n is not null").select(*keys, "__v", "__n.distance", "__n.column", "__n.centre")
    return best(points.withColumn("__v", spot).join(found, [*keys, "__v"]).drop("__v"), keys, [F.col("distance"), F.col("column")])


def first_claims(figures: DataFrame, captions: DataFrame, keys: Sequence[str], below: float = 12.0) -> DataFrame:
    """Sub-captions inside or just below a figure and beside it, each given to the first figure (order) that may have it."""
    pairs = touching(captions, figures, keys, below)
    ok = (F.col("x0") < F.col("r_x1")) & (F.col("x1") > F.col("r_x0")) & (F.col("y0") >= F.col("r_y0")) & (F.col("y0") <= F.col("r_y1") + below)
    return best(pairs.where(ok), keys, [F.col("r_order")])


#: Starts up to this number, which are counted first, are sent to where the rows are.
FEW_STARTS = 512


def intervals(rows: DataFrame, starts: DataFrame, value: str, start: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows with the interval that holds their value: from a start up to the next one of the same keys.

    Few starts are looked up where the rows are. Many are events between the rows in one sort, so no row is
    compared with every interval.
    """
    names = [c for c in starts.columns if c not in keys]
    payload = F.struct(*(F.col(c) for c in names))
    if starts.limit(FEW_STARTS + 1).count() <= FEW_STARTS:
        lists = starts.where(F.col(start).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(start).alias("v"), payload.alias("p")))).alias("__starts"))
        both = rows.join(F.broadcast(lists), list(keys), "left") if keys else rows.join(F.broadcast(lists), how="left")
        held = F.try_element_at(F.filter("__starts", lambda x: x["v"] <= F.col(value)), F.lit(-1))["p"]
        found = both.withColumn("__start", held).drop("__starts")
        return found.select(*rows.columns, *(F.col(f"__start.{c}").alias(f"interval_{c}") for c in names))
    events = starts.select(*keys, F.col(start).alias("__v"), F.lit(0).alias("__kind"), payload.alias("__start"), F.lit(None).cast(rows.select(F.struct("*")).schema[0].dataType).alias("__row"))
    points = rows.select(*keys, F.col(value).alias("__v"), F.lit(1).alias("__kind"), F.lit(None).cast(starts.select(payload).schema[0].dataType).alias("__start"), F.struct("*").alias("__row"))
    w = Window.partitionBy(*keys).orderBy("__v", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    found = events.unionByName(points).withColumn("__start", F.last("__start", ignorenulls=True).over(w)).where("__kind = 1")
    return found.select("__row.*", *(F.col(f"__start.{c}").alias(f"interval_{c}") for c in names))


def clipped_ends(chapters: DataFrame, dividers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Chapters (number, pdf_page) with their last page: before the next chapter, or before the first divider inside."""
    w = Window.partitionBy(*keys).orderBy("pdf_page")
    c = chapters.withColumn("next_page", F.lead("pdf_page").over(w))
    d = dividers.select(*keys, F.col("pdf_page").alias("divider"))
    inside = (F.col("divider") > F.col("pdf_page")) & (F.col("next_page").isNull() | (F.col("divider") < F.col("next_page")))
    cut = c.join(d, list(keys), "left").groupBy(*c.columns).agg(F.min(F.when(inside, F.col("divider"))).alias("divider"))
    return cut.withColumn("pdf_page_end", F.coalesce("divider", "next_page") - 1)
