"""Queries over a few literal rows each, for rules that the generated tables never exercise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.functions import kernel as k
from collatio.functions import markdown as m
from collatio.operators import contents, emit, equations, gates, geometry, layout
from collatio.plans.registry import query
from collatio.sources import readers

BOX = "page int, id int, x0 double, y0 double, x1 double, y1 double"


def texts(spark: SparkSession, *rows: tuple) -> DataFrame:
    """id from 1 and the columns a, b, c as strings."""
    names = "abcd"[: len(rows[0])]
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], "id int, " + ", ".join(f"{n} string" for n in names))


@query("SELECT * FROM (VALUES (1, 'network'), (2, 'erdös'), (3, 'efficient flow'), (4, '\"a\" ''b'''), (5, 'a-b'), (6, '1⁄2 12'), (7, NULL)) AS t(id, v)")
def exact_normal_form(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, ("net-\nwork",), ("Erd¨os",), ("Eﬃcient ﬂow",), ("“a” ‘b’",), ("a–b",), ("½ １２",), (None,)).select("id", k.exact_normal(F.col("a")).alias("v"))


@query("SELECT * FROM (VALUES (1, 'Erdös'), (2, 'efficient'), (3, 'A–b')) AS t(id, v)")
def output_form(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, ("Erd¨os",), ("eﬃcient",), ("A–b",)).select("id", k.output_form(F.col("a")).alias("v"))


@query("SELECT * FROM (VALUES (1, 'a well-known case'), (2, 'a network'), (3, '1872–81'), (4, 'one two')) AS t(id, v)")
def hyphen_joins(spark: SparkSession, d: str) -> DataFrame:
    rows = texts(spark, ("a well-", "known case"), ("a net-", "work"), ("1872–", "81"), ("one", "two"))
    return rows.select("id", k.join_hyphenated(F.col("a"), F.col("b"), F.array(F.lit("well-known"))).alias("v"))


@query("SELECT * FROM (VALUES (1, 'a network of well-known cases')) AS t(id, v)")
def joined_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(1, ["a net-", "work of well-", "known cases"])], "id int, l array<string>").select("id", k.joined_lines(F.col("l"), F.array(F.lit("well-known"))).alias("v"))


@query("SELECT * FROM (VALUES (1, true), (2, false), (3, false), (4, false), (5, true)) AS t(id, v)")
def integer_soup(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, ("1 2 3 4 5 6 7 8 9 10 11",), ("1 2 3",), ("0 0 0 0 0 0 1",), ("In 1872 the 12 met 3 times, 4 won.",), ("−65 −51 3.5 4 5 6",)).select("id", k.is_integer_soup(F.col("a")).alias("v"))


@query("SELECT * FROM (VALUES (1, true), (2, true), (3, false), (4, false), (5, true), (6, true)) AS t(id, v)")
def payoff_shapes(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, ("90, 90",), (".48, .12",), ("200, 000",), ("AA, AB",), ("(a, b)+, (a, b)+",), ("1, 2, 3",)).select("id", k.is_payoff(F.col("a")).alias("v"))


@query("SELECT * FROM (VALUES (1, '1, -0.5'), (2, '0.48, 0.12'), (3, '-1, 1')) AS t(id, v)")
def canonical_payoffs(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, ("+1 , −.5",), (".48,.12",), ("−1, +1",)).select("id", k.canonical_payoff(F.col("a")).alias("v"))


@query("SELECT * FROM (VALUES (1, 'A game, shown'), (2, 'Figure from the text; see the surrounding discussion.'), (3, repeat('word ', 47) || 'word…')) AS t(id, v)")
def alt_texts(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, ("A [12] game , [shown]",), (None,), ("word " * 80,)).select("id", k.alt_text(F.col("a")).alias("v"))


@query("""SELECT * FROM (VALUES (1, 'at <span class="node">mit</span>, not permit')) AS t(id, v)""")
def small_caps(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, ("at mit, not permit",)).select("id", k.small_caps_spans(F.col("a"), F.array(F.lit("mit,"), F.lit("a"))).alias("v"))


@query("SELECT * FROM (VALUES (1, '( .8)( .4) = .32'), (2, 'end. 8 more')) AS t(id, v)")
def repaired_decimals(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, ("( . 8)( . 4) = . 32",), ("end. 8 more",)).select("id", k.repair_decimals(F.col("a")).alias("v"))


@query("SELECT * FROM (VALUES (0, 'Preface', 'ch00', 'ix', 'part1-graph-theory'), (7, '7. Games', 'ch07', '9', 'part1-graph-theory')) AS t(n, title, chapter, page, part)")
def chapter_names(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(0, "Preface"), (7, "Games")], "n int, t string")
    return rows.select("n", k.display_title(F.col("n"), F.col("t")).alias("title"), k.chapter_id(F.col("n")).alias("chapter"), k.printed_page(F.lit(9), F.col("n")).alias("page"), k.part_slug(F.lit(1), F.lit("Graph Theory")).alias("part"))


@query("SELECT * FROM (VALUES (1, true), (2, true), (3, false)) AS t(id, v)")
def malformed_latex(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, ("{x",), ("\\begin{a}",), ("\\begin{a}{x}\\end{a}",)).select("id", k.malformed_latex(F.col("a")).alias("v"))


@query("SELECT * FROM (VALUES (1, 'a < b & c'), (2, NULL)) AS t(id, v)")
def unescaped_html(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, ("a &lt; b &amp; c",), (None,)).select("id", equations.unescaped(F.col("a")).alias("v"))


@query("SELECT * FROM (VALUES (1, 'fixed'), (2, 'same')) AS t(id, v)")
def corrections(spark: SparkSession, d: str) -> DataFrame:
    found = spark.createDataFrame([(1, 71, "bad"), (2, 72, "same")], "id int, page int, latex string")
    return equations.corrected(found, spark.createDataFrame([(71, "bad", "fixed"), (72, "bad", "no")], "page int, latex string, replacement string")).select("id", F.col("latex").alias("v"))


PAGE = "---\nid: x\n---\n\n# Title\n\n## 2.1 Graphs {#sec-2-1}\n\nA **bold** [link](/a#b) and ![alt](/img/a.png) $x\\alpha$ $5 to $6\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n\n> note\n<!-- gone -->\n```\ncode\n```\n<a id='z'></a><span class=\"figure-data\">7</span>"


@query("SELECT * FROM (VALUES (1, '2 1 graphs a bold link and 5 to 6 a b 1 2 note 7', '2 1 graphs a bold link and 5 to 6 a b 1 2 note')) AS t(id, words, numbers_side)")
def markdown_words(spark: SparkSession, d: str) -> DataFrame:
    words = lambda strip: F.array_join(k.tokens(m.plain_text(F.col("a"), strip)), " ")
    return texts(spark, (PAGE,)).select("id", words(False).alias("words"), words(True).alias("numbers_side"))


@query("SELECT * FROM (VALUES ('/p/graphs', NULL), ('/p/graphs', 'sec-2-1'), ('/p/graphs', 'z'), ('/', NULL)) AS t(route, anchor)")
def site_index(spark: SparkSession, d: str) -> DataFrame:
    pages = spark.createDataFrame([("p/02-graphs.md", PAGE.replace("id: x\n", "")), ("index.md", "---\nslug: /\n---\n")], "path string, markdown string")
    return emit.site_index(pages)


@query("SELECT * FROM (VALUES ('a.md', '/x', 'y'), ('a.md', '/', NULL)) AS t(path, route, anchor)")
def site_links(spark: SparkSession, d: str) -> DataFrame:
    return emit.site_links(spark.createDataFrame([("a.md", "[a](/x/#y) [b](/img/f.png) [c](/) [d](https://e.org)")], "path string, markdown string"))


@query("SELECT * FROM (VALUES ('a.png', 'not_in_markdown'), ('b.png', 'not_in_html')) AS t(file, issue)")
def hidden_assets(spark: SparkSession, d: str) -> DataFrame:
    a = spark.createDataFrame([(1, "a.png", bytearray(b"xyz")), (1, "b.png", bytearray(b"uvw"))], "chapter int, file string, content binary")
    docs = spark.createDataFrame([(1, "![x](/b.png)")], "chapter int, markdown string")
    return emit.rendered_assets(a, docs, spark.createDataFrame([(1, "<img src='a.png'>")], "chapter int, html string"), ["chapter"]).drop("chapter")


@query("SELECT * FROM (VALUES (1, true), (2, true), (3, false)) AS t(id, v)")
def printed_rules(spark: SparkSession, d: str) -> DataFrame:
    b = spark.createDataFrame([(1, 1, 0.0, 0.0, 200.0, 4.0), (1, 2, 0.0, 0.0, 14.0, 400.0), (1, 3, 0.0, 0.0, 100.0, 40.0)], BOX)
    return b.select("id", geometry.is_rule(geometry.box()).alias("v"))


@query("SELECT * FROM (VALUES (1, 'no_bbox'), (2, 'too_small'), (3, NULL)) AS t(id, v)")
def asset_boxes(spark: SparkSession, d: str) -> DataFrame:
    b = spark.createDataFrame([(1, 1, None, None, None, None), (1, 2, 0.0, 0.0, 10.0, 100.0), (1, 3, 0.0, 0.0, 100.0, 100.0)], BOX)
    return b.select("id", geometry.asset_issue(geometry.box(), [F.lit(0.0), F.lit(0.0), F.lit(612.0), F.lit(792.0)]).alias("v"))


def _nested(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    lines = spark.createDataFrame([(1, 1, 10.0, 10.0, 50.0, 20.0), (1, 2, 300.0, 300.0, 350.0, 310.0)], BOX)
    return lines, spark.createDataFrame([(1, 7, 0.0, 0.0, 200.0, 200.0), (1, 8, 5.0, 5.0, 60.0, 30.0)], BOX)


@query("SELECT * FROM (VALUES (1, 8)) AS t(id, box)")
def smallest_container(spark: SparkSession, d: str) -> DataFrame:
    return geometry.smallest_container(*_nested(spark), ["page"]).select("id", F.col("r_id").alias("box"))


@query("SELECT 2 AS id")
def suppressed_boxes(spark: SparkSession, d: str) -> DataFrame:
    return geometry.outside(*_nested(spark), ["page"], 0.5).select("id")


@query("SELECT 1 AS id")
def interior_lines(spark: SparkSession, d: str) -> DataFrame:
    return geometry.interior(*_nested(spark), ["page"]).select("id")


@query("SELECT * FROM (VALUES (11, 1), (12, 2)) AS t(caption, figure)")
def subcaption_claims(spark: SparkSession, d: str) -> DataFrame:
    """The first caption is below both figures and goes to the first one; the second is beside the first figure's reach."""
    figures = spark.createDataFrame([(1, 1, 0.0, 0.0, 100.0, 100.0), (1, 2, 50.0, 0.0, 200.0, 100.0)], BOX).withColumn("order", F.col("id"))
    captions = spark.createDataFrame([(1, 11, 60.0, 105.0, 90.0, 115.0), (1, 12, 150.0, 105.0, 190.0, 115.0), (1, 13, 60.0, 150.0, 90.0, 160.0)], BOX)
    return geometry.first_claims(figures, captions, ["page"]).select(F.col("id").alias("caption"), F.col("r_id").alias("figure"))


@query("SELECT * FROM (VALUES (90, 592.0::DOUBLE, 10.0::DOUBLE), (180, 512.0::DOUBLE, 592.0::DOUBLE), (0, 10.0::DOUBLE, 100.0::DOUBLE)) AS t(rotation, x0, y0)")
def rotated_boxes(spark: SparkSession, d: str) -> DataFrame:
    b = spark.createDataFrame([(r, 10.0, 100.0, 100.0, 200.0) for r in (90, 180, 0)], "rotation int, x0 double, y0 double, x1 double, y1 double").withColumns({"page_width": F.lit(612.0), "page_height": F.lit(792.0)})
    return layout.rotated(b).select("rotation", "x0", "y0")


@query("SELECT 2 AS page, 'a' || chr(10) || 'b' AS text")
def clipped_text(spark: SparkSession, d: str) -> DataFrame:
    ls = spark.createDataFrame([(2, 1, "a", 10.0, 10.0, 20.0, 20.0), (2, 2, "b", 10.0, 30.0, 20.0, 40.0), (2, 3, "c", 10.0, 300.0, 20.0, 310.0)], "page int, line_no int, text string, x0 double, y0 double, x1 double, y1 double")
    return layout.clipped_text(ls, ["page"], 0.0, 0.0, 100.0, 100.0)


@query("SELECT * FROM (VALUES (3, 1), (12, 2), (15, 2)) AS t(page, chapter)")
def pages_of_chapters(spark: SparkSession, d: str) -> DataFrame:
    chapters = spark.createDataFrame([("b", 1, 2, 9), ("b", 2, 12, 15)], "book_id string, number int, pdf_page int, pdf_page_end int")
    return readers.chapter_pages(spark.createDataFrame([("b", p) for p in (1, 3, 10, 12, 15, 16)], "book_id string, page int"), chapters).select("page", "chapter")


@query("SELECT * FROM (VALUES (2), (3)) AS t(page)")
def contents_pages(spark: SparkSession, d: str) -> DataFrame:
    p = spark.createDataFrame([("b", i + 1, t) for i, t in enumerate(("x", "Contents", "contents ii", "y", "contents again"))], "book_id string, page int, text string")
    return contents.contents_pages(p).select("page")


@query("SELECT * FROM (VALUES ('5.5', 5), ('6.1', 6)) AS t(number, chapter)")
def section_chapters(spark: SparkSession, d: str) -> DataFrame:
    s = spark.createDataFrame([("b", "5.5"), ("b", "6.1"), ("b", "9.9")], "book_id string, number string")
    return contents.section_chapters(s, spark.createDataFrame([("b", 5), ("b", 6)], "book_id string, number int")).select("number", "chapter")


@query("SELECT 12 AS page")
def heading_page(spark: SparkSession, d: str) -> DataFrame:
    ls = spark.createDataFrame([("b", 11, 1, "Index", 10.0), ("b", 12, 2, " Index", 20.0), ("b", 13, 9, "Index", 20.0)], "book_id string, page int, line_no int, text string, size double")
    return contents.heading_page(ls, "Index").select("page")


@query("SELECT * FROM (VALUES ('page_size', '612 x 792'), ('tagged', 'no')) AS t(key, value)")
def tool_fields(spark: SparkSession, d: str) -> DataFrame:
    return readers.info_fields(spark.createDataFrame([("Page size: 612 x 792\nTagged: no",)], "text string"))


@query("SELECT 'b' AS book_id, 1::BIGINT AS chapters_green, 2::BIGINT AS chapters_total, 10::BIGINT AS pages_green, 30::BIGINT AS pages_total")
def progress_table(spark: SparkSession, d: str) -> DataFrame:
    return emit.progress_table(spark.createDataFrame([("b", "green", 10), ("b", "failing", 20)], "book_id string, status string, n_pages int"), ["book_id"])


@query("SELECT * FROM (VALUES (1, 'part1/02-long-paths'), (2, '00-preface')) AS t(id, v)")
def document_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(1, "part1", 2, "Long Paths"), (2, None, 0, "Preface")], "id int, p string, n int, t string")
    return rows.select("id", emit.document_path(F.col("p"), F.col("n"), F.col("t")).alias("v"))


@query("SELECT * FROM (VALUES (1, 'PASS'), (2, 'FAIL'), (3, 'BLOCKED')) AS t(chapter, status)")
def build_gate(spark: SparkSession, d: str) -> DataFrame:
    logs = spark.createDataFrame([(1, True, 0, "fine"), (2, True, 0, "Warning: x"), (3, False, None, None)], "chapter int, requested boolean, exit_code int, output string")
    return gates.build(logs, ["chapter"]).select("chapter", "status")


@query("SELECT * FROM (VALUES (1, 'PASS'), (2, 'PASS'), (3, 'FAIL')) AS t(chapter, status)")
def math_gate(spark: SparkSession, d: str) -> DataFrame:
    ch = spark.createDataFrame([(1,), (2,), (3,)], "chapter int")
    return gates.math(ch, spark.createDataFrame([(2, "x+1", None), (3, "x", None)], "chapter int, latex string, error string"), ["chapter"], True).select("chapter", "status")


@query("SELECT * FROM (VALUES (1, 'PASS'), (2, 'FAIL')) AS t(chapter, status)")
def structural_gate(spark: SparkSession, d: str) -> DataFrame:
    schema = "chapter int, figures array<string>, tables array<string>, sections array<string>, equations array<string>, exercises int, footnotes int"
    a = spark.createDataFrame([(1, ["1.1"], [], ["1.1"], [], None, 2), (2, ["2.1"], [], [], [], 1, 0)], schema)
    b = spark.createDataFrame([(1, ["1.1"], [], ["1.1"], [], None, 2), (2, ["2.1"], [], [], [], 2, 0)], schema)
    return gates.structural_counts(a, b, ["chapter"]).select("chapter", "status")


@query("SELECT * FROM (VALUES (1, 'PASS'), (2, 'FAIL')) AS t(chapter, status)")
def payoff_gate(spark: SparkSession, d: str) -> DataFrame:
    side = lambda *rows: spark.createDataFrame(list(rows), "chapter int, cell string")
    return gates.payoff_cells(side((1, "+1, .5"), (2, "1, 2")), side((1, "1, 0.5"), (2, "2, 1")), ["chapter"]).select("chapter", "status")


@query("SELECT * FROM (VALUES (1, 'PASS'), (2, 'FAIL')) AS t(chapter, status)")
def xref_gate(spark: SparkSession, d: str) -> DataFrame:
    ch = spark.createDataFrame([(1,), (2,)], "chapter int")
    site = spark.createDataFrame([("/a", None), ("/a", "x")], "route string, anchor string")
    links = spark.createDataFrame([(1, "/a/", "x"), (1, "/a", None)], "chapter int, route string, anchor string")
    return gates.xrefs(ch, links, site, spark.createDataFrame([(1, "Figure 9.1"), (2, "Figure 1.1")], "chapter int, label string"), ["chapter"]).select("chapter", "status")


@query("SELECT 'b' AS book_id, '- [Preface](/00-preface)' || chr(10) || '## Part 1' || chr(10) || '- [1. Overview](/p/01-overview)' || chr(10) || '- [2. Graphs](/p/02-graphs)' AS markdown")
def home_page(spark: SparkSession, d: str) -> DataFrame:
    c = spark.createDataFrame([("b", 1, 2, "Graphs", "p/02-graphs"), ("b", None, 0, "Preface", "00-preface"), ("b", 1, 1, "Overview", "p/01-overview")], "book_id string, part int, number int, title string, path string")
    return emit.home_page(emit.sidebar(c))


@query("SELECT '# Book' || chr(10) || chr(10) || '1 of 2 chapters and 10 of 30 pages pass every check.' || chr(10) AS markdown")
def starter_readme(spark: SparkSession, d: str) -> DataFrame:
    return emit.starter_readme(progress_table(spark, d), "Book")


@query("SELECT * FROM (VALUES ('erdös', 75.0::DOUBLE, 'a < b', '12')) AS t(a, b, c, d)")
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """The Arrow functions from SQL."""
    from collatio.functions.sql import register

    register(spark)
    return spark.sql("SELECT repair_accents('erd¨os') AS a, indel_ratio('abcd', 'abxd') AS b, unescape_html('a &lt; b') AS c, nfkc('１２') AS d")
