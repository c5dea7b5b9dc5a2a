"""Gates that must be able to fail, ties, empty tables, sinks and streams."""

import ast
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from collatio.functions import kernel
from collatio.operators import aggregates, contents, emit, gates, geometry, multiset, reconcile
from collatio.sources import readers, sinks
from collatio.streaming import incremental


def bags(spark, ref, cand, what=kernel.tokens):
    frame = lambda t: spark.createDataFrame([(1, t)], "chapter int, text string")
    return [multiset.bag(frame(t), what(F.col("text")), ["chapter"]) for t in (ref, cand)]


def test_coverage_can_fail_and_block(spark):
    status = lambda a, b: [r.status for r in gates.text_coverage(*bags(spark, a, b), ["chapter"]).collect()]
    words = " ".join(f"w{i}" for i in range(1000))
    assert status(words, words) == ["PASS"] and status(words, words.replace("w7 ", "")) == ["PASS"] and status(words, words.replace("w7 ", "").replace("w8 ", "")) == ["FAIL"]
    assert status("", "extra") == ["BLOCKED"]


def test_numbers_are_two_sided(spark):
    status = lambda a, b: gates.numeric_fidelity(*bags(spark, a, b, kernel.numbers), ["chapter"]).first().status
    assert status("1 2 3", "3 2 1") == "PASS" and status("1 2", "1 3") == "FAIL" and status("1", "1 2") == "FAIL"


def test_structural_counts(spark):
    schema = "chapter int, figures array<string>, tables array<string>, sections array<string>, equations array<string>, exercises int, footnotes int"
    one = spark.createDataFrame([(1, ["1.1"], [], ["1.1"], [], None, 2)], schema)
    assert gates.structural_counts(one, one, ["chapter"]).first().status == "PASS"
    for other in ([(1, ["1.2"], [], ["1.1"], [], None, 2)], [(1, ["1.1"], [], ["1.1"], [], None, 3)], []):
        assert gates.structural_counts(one, spark.createDataFrame(other, schema), ["chapter"]).first().status == "FAIL"


def test_math_and_build(spark):
    ch = spark.createDataFrame([(1,), (2,), (3,)], "chapter int")
    eq = spark.createDataFrame([(2, "x+1", None), (3, "x", None)], "chapter int, latex string, error string")
    got = lambda c: {r.chapter: r.status for r in gates.math(ch, eq, ["chapter"], c).collect()}
    assert got(True) == {1: "PASS", 2: "PASS", 3: "FAIL"} and got(False)[2] == "BLOCKED"
    logs = spark.createDataFrame([(1, True, 0, "fine"), (2, True, 0, "Warning: x"), (3, True, 1, ""), (4, False, None, None), (5, True, 0, "forewarned")], "chapter int, requested boolean, exit_code int, output string")
    assert {r.chapter: r.status for r in gates.build(logs, ["chapter"]).collect()} == {1: "PASS", 2: "FAIL", 3: "FAIL", 4: "BLOCKED", 5: "PASS"}


def test_xrefs(spark):
    ch = spark.createDataFrame([(1,), (2,)], "chapter int")
    site = spark.createDataFrame([("/a", None), ("/a", "x")], "route string, anchor string")
    links = spark.createDataFrame([(1, "/a/", "x"), (1, "/a", None), (2, "/a", "y")], "chapter int, route string, anchor string")
    deferred = spark.createDataFrame([(1, "Figure 9.1"), (1, "Exercise 2")], "chapter int, label string")
    assert {r.chapter: r.status for r in gates.xrefs(ch, links, site, deferred, ["chapter"]).collect()} == {1: "PASS", 2: "FAIL"}
    wrong = spark.createDataFrame([(1, "Figure 2.1")], "chapter int, label string")
    assert {r.chapter: r.status for r in gates.xrefs(ch, links, site, wrong, ["chapter"]).collect()}[1] == "FAIL"


def test_status_reduction(spark):
    rows = [(1, "a", "PASS", True), (2, "a", "FAIL", True), (2, "b", "BLOCKED", True), (3, "a", "BLOCKED", True), (4, "visual", "FAIL", False), (5, "visual", "REVIEWED", False)]
    g = spark.createDataFrame(rows, "chapter int, gate string, status string, hard boolean")
    none = spark.createDataFrame([], "chapter int, reason string, text string")
    q = gates.review_queue(none, g, ["chapter"])
    assert {r.chapter: r.status for r in gates.chapter_status(g, q, ["chapter"]).collect()} == {1: "PASS", 2: "FAIL", 3: "BLOCKED", 4: "REVIEW", 5: "PASS"}


def test_first_seen_mode_and_upper_median(spark):
    df = spark.createDataFrame([(1, 12.0), (2, 9.0), (3, 9.0), (4, 12.0), (5, None)], "i int, v double")
    assert aggregates.first_seen_mode(df, "v", "i").first()["mode"] == 12.0
    assert aggregates.upper_median(df, "v", []).first().upper_median == 12.0
    assert aggregates.first_seen_mode(df.where("false"), "v", "i", ["i"]).count() == 0


def test_top_keeps_first_seen_order(spark):
    b = multiset.bag(spark.createDataFrame([(1, "z a z a q")], "d int, t string"), kernel.tokens(F.col("t")), ["d"])
    assert [r.token for r in multiset.top(b, "n", ["d"], 2).orderBy("rank").collect()] == ["z", "a"]


def test_spatial_joins_meet_once(spark):
    schema = "page int, id int, x0 double, y0 double, x1 double, y1 double"
    tall, wide = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 500.0)], schema), spark.createDataFrame([(1, 7, 0.0, 10.0, 10.0, 480.0), (2, 8, 0.0, 0.0, 1.0, 1.0)], schema)
    assert geometry.overlapping(tall, wide, ["page"], 0.5).count() == 1
    assert geometry.outside(tall, wide, ["page"], 0.5).count() == 0 and geometry.outside(tall, wide.where("page = 2"), ["page"], 0.5).count() == 1
    zero = spark.createDataFrame([(1, 1, 5.0, 5.0, 5.0, 5.0)], schema)
    assert geometry.overlapping(zero, zero, ["page"], 0.1).count() == 0


def test_recovered_figures(spark):
    schema = "book_id string, chapter int, page int, block_no int, type string, text string, label string, label_kind string, unresolved boolean, x0 double, y0 double, x1 double, y1 double"
    long = "word " * 50
    rows = [(1, "paragraph", long, None, None, False, 0.0, 10.0), (2, "paragraph", "a b", None, None, False, 50.0, 60.0), (3, "caption", "(a) part", None, None, False, 70.0, 80.0), (4, "caption", "Figure 1.1: x", "1.1", "figure", True, 90.0, 99.0)]
    df = spark.createDataFrame([("b", 1, 1, n, t, x, lab, kind, u, 0.0, y0, 10.0, y1) for n, t, x, lab, kind, u, y0, y1 in rows], schema)
    r = reconcile.recovered_figures(df).first()
    assert (r.block_no, r.y0, r.y1, sorted(r.replaces)) == (4, 50.0, 80.0, [2, 3])


def test_reference_lines(spark):
    schema = "book_id string, chapter int, page int, id long, text string, size double, x0 double, y0 double, x1 double, y1 double, is_caption boolean, figure long, half_figure long, furniture string, reason string"
    rows = [(1, "Figure 1.1: x", 10.0, True, 5, 5, None, None), (2, "goes on", 20.0, False, None, 5, None, "figure_interior"), (3, "tick", 90.0, False, None, 5, None, "figure_interior"), (4, "text", 120.0, False, None, None, None, None)]
    df = spark.createDataFrame([("b", 1, 1, i, t, 9.0, 0.0, y, 9.0, y + 8, c, f, h, fu, re) for i, t, y, c, f, h, fu, re in rows], schema)
    assert {r.id: r.removed for r in reconcile.reference_lines(df).collect()} == {1: None, 2: None, 3: "figure_interior", 4: None}


def test_contents_pages_and_checks(spark):
    p = spark.createDataFrame([("b", 1, "x"), ("b", 2, "Contents"), ("b", 3, "contents ii"), ("b", 4, "y"), ("b", 5, "contents again")], "book_id string, page int, text string")
    assert sorted(r.page for r in contents.contents_pages(p).collect()) == [2, 3]
    try:
        contents.checked(p, F.col("page") < 3, "no more than two pages").collect()
        raise AssertionError("it passed")
    except Exception as e:
        assert "no more than two pages" in str(e)


def test_tool_output(spark):
    t = lambda s: spark.createDataFrame([(s,)], "text string")
    assert {(r.key, r.value) for r in readers.info_fields(t("Page size: 612 x 792\nTagged: no")).collect()} == {("page_size", "612 x 792"), ("tagged", "no")}
    fonts = "name type emb\n---- ----\nCMR10 Type 1 Custom yes yes no 5 0"
    assert [(r.name, r.embedded, r.mapped) for r in readers.font_table(t(fonts)).collect()] == [("CMR10", True, False)]
    assert [(r.page, r.n) for r in readers.images_per_page(t("page num\n---\n  3  0 image\n  3  1 image")).collect()] == [(3, 2)]


def test_sinks_replace_chapters_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = lambda v: spark.createDataFrame([("b", c, v) for c in ((1, 2) if v == 0 else (2,))], "book_id string, chapter int, v int")
    sinks.write_chapters(df(0), path)
    sinks.write_chapters(df(1), path)
    assert {(r.chapter, r.v) for r in sinks.read_back(spark, path).collect()} == {(1, 0), (2, 1)}


def test_stream_rechecks_chapters(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("b", 1, "a b"), ("b", 2, "c")], "book_id string, chapter int, text string").write.parquet(source)
    check = lambda df: df.groupBy("book_id", "chapter").agg(F.sum(F.size(kernel.tokens(F.col("text")))).alias("n"))
    incremental.on_arrival(spark, source, "book_id string, chapter int, text string", check, sink, str(tmp_path / "cp")).awaitTermination(60)
    assert {(r.chapter, r.n) for r in sinks.read_back(spark, sink).collect()} == {(1, 2), (2, 1)}


def test_pages_are_read_with_their_paths(spark, tmp_path):
    (tmp_path / "docs/p").mkdir(parents=True)
    (tmp_path / "docs/p/02-g.md").write_text("x\ny")
    assert [tuple(r) for r in readers.read_pages(spark, str(tmp_path / "docs")).collect()] == [("p/02-g.md", "x\ny")]


def test_nothing_else_imports_llm():
    root = Path(__file__).resolve().parent.parent / "collatio"
    for f in root.rglob("*.py"):
        if "llm" in f.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(f.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n for n in names), f


def test_entries_that_wrap(spark):
    """A continuation may look like an entry itself; a page number stands apart; Roman ones may be capitals."""
    lines = ["1.2 Games of   ", "2 Players and More   33", "1.3 Version 1.5", "of it   40", "Preface   IX", "Contents", "1.4 Last one   50"]
    df = spark.createDataFrame([("b", i, t) for i, t in enumerate(lines)], "book_id string, line_no int, text string")
    got = [r.text for r in contents.joined_entries(df).orderBy("line_no").collect()]
    assert got == ["1.2 Games of 2 Players and More   33", "1.3 Version 1.5 of it   40", "Preface   IX", "Contents", "1.4 Last one   50"]


def test_ordinals_before_titles(spark):
    df = spark.createDataFrame([("III. Games", "Games"), ("6 – Games", "Games"), ("Chapter 6 Games", "Games"), ("12: Games", "Games"), ("Games", "Games"), ("Other Games", "Games")], "c string, t string")
    got = [r[0] for r in df.select(contents.title_score(F.col("c"), F.col("t"))).collect()]
    assert all(s >= contents.MATCH for s in got[:5]) and got[5] < contents.MATCH


def test_boundary_map_fails_without_its_parts(spark):
    lines = [("b", p, n, t, s) for p, n, t, s in [(3, 0, "Preface", 20.0), (5, 0, "One", 20.0), (9, 0, "Index", 20.0)]] + [("b", p, n, "text", 10.0) for p in range(3, 11) for n in range(1, 5)]
    toc = [("b", 1, "1  One     1")]

    def found(lines, toc):
        return contents.boundary_map(spark.createDataFrame(lines, "book_id string, page int, line_no int, text string, size double"), spark.createDataFrame(toc, "book_id string, line_no int, text string")).orderBy("number").collect()

    assert [(r.number, r.title, r.pdf_page, r.pdf_page_end) for r in found(lines, toc)] == [(0, "Preface", 3, 4), (1, "One", 5, 8)]
    for bad, contents_of in ((lines[1:], toc), (lines, [("b", 1, "nothing")]), (lines, [*toc, ("b", 2, "2  Two     9")])):
        with pytest.raises(Exception, match="no preface|no chapter|begins on no page"):
            found(bad, contents_of)


def test_citations_of_other_books_stay(spark):
    texts = spark.createDataFrame([("a", 1, "see [7] and Section 1.2"), ("b", 1, "see [7] and Section 1.2"), ("c", 1, "see [7]")], "book_id string, id int, text string")
    places = spark.createDataFrame([("b", "Section", "1.2", "p", "sec-1-2")], "book_id string, kind string, label string, path string, anchor string")
    entries = spark.createDataFrame([("a", 7), ("b", 8)], "book_id string, number int")
    out, unresolved = emit.linked(texts, places, entries, ["book_id"])
    got = {r.book_id: r.text for r in out.collect()}
    assert "ref-7" in got["a"] and "sec-1-2" not in got["a"] and "ref-7" not in got["b"] and "sec-1-2" in got["b"] and got["c"] == "see [7]"
    assert {(r.book_id, r.reason) for r in unresolved.collect()} == {("a", "target_not_emitted"), ("c", "no_bibliography")}


def test_many_starts_are_looked_up_alike(spark, monkeypatch):
    rows = spark.range(200).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    starts = spark.createDataFrame([(k, 10 * i + k, i) for k in (0, 1) for i in range(8)], "k long, s long, number int")
    few = geometry.intervals(rows, starts, "v", "s", ["k"]).collect()
    monkeypatch.setattr(geometry, "FEW_STARTS", 3)
    assert sorted(map(tuple, few), key=str) == sorted(map(tuple, geometry.intervals(rows, starts, "v", "s", ["k"]).collect()), key=str)
