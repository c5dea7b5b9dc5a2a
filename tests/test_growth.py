"""Steps whose work must grow with the input and not with its square."""

import re
import unicodedata

from collatio.functions import kernel
from collatio.operators import geometry
from collatio.plans.catalog import QUERIES


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_not_searched_for_boilerplate(spark, sf_dir):
    """No document's lines are looked up in an array of all boilerplate or of its own lines."""
    for name in ("text_coverage", "coverage_by_language", "numeric_fidelity", "numeric_by_language", "gate_status_rollup", "progress_status", "review_queue", "review_rows"):
        p = plan(QUERIES[name](spark, sf_dir))
        assert "array_except" not in p and "array_contains" not in p


def test_lines_are_counted_by_mask(spark, sf_dir):
    """Lines meet the known masks by counts, not in a join."""
    for name in ("line_furniture_reason", "removed_by_reason"):
        assert "Join" not in plan(QUERIES[name](spark, sf_dir))


def boxes(spark, n):
    """A page with n copies of a line and n copies of a box around it."""
    one = spark.range(n).selectExpr("1 page", "id", "0D x0", "0D y0", "10D x1", "10D y1")
    return one, one.selectExpr("page", "id + 100 id", "x0 - 1 x0", "y0 - 1 y0", "x1 + 1 x1", "y1 + 1 y1")


def test_copies_of_boxes_meet_once(spark):
    """Three thousand lines in three thousand copies of a box make no nine million pairs before one of each is kept."""
    lines, around = boxes(spark, 3000)
    rows = geometry.owner(lines, around, ["page"])
    assert [tuple(r) for r in rows.groupBy("r_id").count().collect()] == [(100, 3000)]
    assert geometry.overlapping(lines, geometry.distinct_boxes(around, ["page"]), ["page"], 0.5).count() == 3000
    assert geometry.enclosed(lines, around, ["page"]).count() == 3000 and plan(geometry.enclosed(lines, around, ["page"])).count("Join") == 1
    some, same = boxes(spark, 3)
    assert {(r.id, r.r_id, r.score) for r in geometry.overlapping_ids(some, same, ["page"], 0.6).collect()} == {(i, k, 1.0) for i in range(3) for k in (100, 101, 102)}


def test_nearest_sorts_places(spark):
    centres = spark.createDataFrame([(1, 5, 10.0), (1, 4, 10.0), (1, 3, 14.0), (1, 9, 100.0), (2, 1, None)], "page int, column int, centre double")
    points = spark.createDataFrame([(1, 1, 12.0), (1, 2, 10.0), (1, 3, 36.0), (1, 4, 40.0), (1, 5, 12.0), (1, 6, None), (2, 7, 1.0), (1, 8, 99.0), (1, 9, 13.0), (1, 8, 30.0)], "page int, id int, x double")
    found = geometry.nearest(points, centres, ["page"])
    assert {(r.id, r.column, r.distance) for r in found.collect()} == {(1, 3, 2.0), (5, 3, 2.0), (2, 4, 0.0), (3, 3, 22.0), (8, 9, 1.0), (9, 3, 1.0)}
    assert "__cell" not in plan(found)


def test_composed_characters_never_change():
    """Python may be spared only for characters that no normal form changes or joins to others."""
    joined = {p for c in map(chr, range(0x110000)) for p in unicodedata.normalize("NFD", c)[1:]}
    stable = [c for c in map(chr, range(0x10000)) if re.match(f"[{kernel.COMPOSED}]", c)]
    assert len(stable) > 20_000
    for c in stable:
        assert unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c) and c not in joined and c not in kernel.SPACING_ACCENTS


def test_counting_needs_no_sort(spark, sf_dir):
    """Words are counted by hash: a struct as first place made Spark sort all words."""
    p = QUERIES["token_bag_top"](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in p and "HashAggregate" in p
    assert "Window" in plan(QUERIES["benchmark_recall"](spark, sf_dir))
    assert "FullOuter" not in plan(QUERIES["lost_number_counts"](spark, sf_dir))
