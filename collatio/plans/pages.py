"""Queries over the literal book: layout, reconciliation, contents, emission."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.functions import kernel
from collatio.operators import aggregates, contents, emit, equations, layout, reconcile
from collatio.plans import samples
from collatio.plans.registry import query
from collatio.sources import readers

PAGE = ["book_id", "chapter", "page"]


@query("SELECT * FROM (VALUES (1, 'a fi' || 'nal word'), (2, 'b')) AS t(line_no, text)")
def glyph_lines(spark: SparkSession, d: str) -> DataFrame:
    """A gap makes a blank, a blank glyph isn't doubled, and a line without text is none."""
    chars = [(1, 0, "a", 0.0, 5.0), (1, 1, "fi", 7.0, 12.0), (1, 2, "nal", 12.0, 25.0), (1, 3, " ", 25.0, 28.0), (1, 4, "word", 31.0, 50.0), (2, 0, "b", 0.0, 5.0), (3, 0, " ", 0.0, 4.0)]
    g = spark.createDataFrame([("p", *c) for c in chars], "page string, line_no int, pos int, c string, x0 double, x1 double").withColumns({"y0": F.lit(0.0), "y1": F.lit(10.0), "size": F.lit(10.0), "font": F.lit("CMR10")})
    return layout.lines_of_glyphs(g, ["page"]).select("line_no", "text")


@query("SELECT * FROM (VALUES (1, 'CHAPTER 6. GAMES 155'), (1, '6.1 What is a Game?'), (1, 'Players choose strategies in a net-'), (1, 'work and receive payoffs, see Figure 6.1.'), (1, 'The well-known case has 2 players and 4 outcomes [12].'), (2, 'Your Partner'), (2, 'Left Right'), (2, 'You'), (2, 'Up 90, 90 86, 92'), (2, 'Down 92, 86 88, 88'), (2, 'Figure 6.1: A small game.'), (2, 'After the game, the players part.'), (2, '1 A note about the game.'), (2, '156')) AS t(page, text)")
def row_merge(spark: SparkSession, d: str) -> DataFrame:
    return layout.merged_rows(samples.lines(spark), PAGE).select("page", "text")


@query("SELECT * FROM (VALUES (0, 0, 'You \\ Your Partner'), (0, 1, 'Left'), (0, 2, 'Right'), (1, 0, 'Up'), (1, 1, '90, 90'), (1, 2, '86, 92'), (2, 0, 'Down'), (2, 1, '92, 86'), (2, 2, '88, 88')) AS t(r, c, value)")
def matrix_recovery(spark: SparkSession, d: str) -> DataFrame:
    return layout.long_cells(layout.matrices(samples.lines(spark), PAGE), PAGE).select("r", "c", "value")


@query("SELECT * FROM (VALUES (2, '90, 90'), (2, '86, 92'), (2, '92, 86'), (2, '88, 88')) AS t(page, cell)")
def payoff_census(spark: SparkSession, d: str) -> DataFrame:
    return layout.payoff_census(samples.lines(spark), PAGE).select("page", "cell")


@query("SELECT * FROM (VALUES ('1', true), ('2', true), ('3', true), ('4', true), ('9', false)) AS t(cell, placed)")
def payoff_placement(spark: SparkSession, d: str) -> DataFrame:
    """Four cells in their places, and one that is claimed to stand below the other column."""
    at = [(1, "90, 90", "Up", "Left"), (2, "86, 92", "Up", "Right"), (3, "92, 86", "Down", "Left"), (4, "88, 88", "Down", "Right"), (9, "90, 90", "Up", "Right")]
    cells = spark.createDataFrame([("book", 6, 2, *c, 58.0, 178.0, 306.0, 242.0) for c in at], "book_id string, chapter int, page int, id int, text string, row_header string, col_header string, x0 double, y0 double, x1 double, y1 double")
    return layout.placement(cells, samples.lines(spark), PAGE).select(F.col("id").cast("string").alias("cell"), "placed")


@query("SELECT * FROM (VALUES (0, 0.0, 0.0, 30.0, 22.0, 'marker+docling'), (2, 100.0, 100.0, 120.0, 120.0, 'marker')) AS t(region_no, x0, y0, x1, y1, source)")
def figure_union(spark: SparkSession, d: str) -> DataFrame:
    r = spark.createDataFrame([("b", 0, 0.0, 0.0, 20.0, 20.0, "marker"), ("b", 1, 5.0, 2.0, 30.0, 22.0, "docling"), ("b", 2, 100.0, 100.0, 120.0, 120.0, "marker")], "page string, region_no int, x0 double, y0 double, x1 double, y1 double, source string")
    return layout.figure_regions(r, ["page"]).drop("page")


@query("SELECT * FROM (VALUES ('(a) A triangle with two enemy edges: balanced.'), ('(b) Another that is bal-anced.'), ('A B')) AS t(text)")
def subcaption_reflow(spark: SparkSession, d: str) -> DataFrame:
    """Two sub-captions side by side that wrap; the second one's hyphen belongs to a known form."""
    row = lambda no, text, x, y: ("p", no, text, 8.0, x, y, x + 80.0, y + 8.0, ["CMR8"], [])
    ls = [row(1, "(a) A triangle with two en-", 100.0, 100.0), row(2, "(b) Another that is bal-", 300.0, 100.0), row(3, "A B", 500.0, 60.0), row(4, "emy edges: balanced.", 100.0, 110.0), row(5, "anced.", 300.0, 110.0)]
    df = spark.createDataFrame(ls, f"page string, {layout.LINE}").withColumns({"body_size": F.lit(10.0), "known_hyphens": F.array(F.lit("bal-anced"))})
    return layout.reflowed(df, ["page"]).select("text")


def _facts(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    rows = layout.merged_rows(samples.lines(spark), PAGE).withColumn("id", F.col("line_no").cast("long")).withColumn("page_height", F.lit(792.0))
    reason = F.when(F.col("y0") < 60, "running_header").when((F.col("y0") > 700) & F.col("text").rlike(kernel.FOLIO), "page_folio")
    return rows, reconcile.row_facts(rows, reason, F.lit(10.0), samples.region_sets(spark))


@query("SELECT * FROM (VALUES (1, 'running_header', NULL), (1, 'text', 'heading'), (1, 'text', 'paragraph'), (1, 'text', 'paragraph'), (1, 'text', 'paragraph'), (2, 'matrix_interior', NULL), (2, 'matrix_interior', NULL), (2, 'matrix_interior', NULL), (2, 'matrix_interior', NULL), (2, 'matrix_interior', NULL), (2, 'text', 'caption'), (2, 'text', 'paragraph'), (2, 'text', 'footnote'), (2, 'page_folio', NULL)) AS t(page, role, kind)")
def reconcile_roles(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.segmented(_facts(spark)[1]).select("page", "role", "kind")


def _blocks(spark: SparkSession) -> DataFrame:
    rows, facts = _facts(spark)
    known = rows.groupBy("book_id", "chapter").agg(F.array_distinct(F.flatten(F.collect_list(kernel.hyphenated_forms(F.col("text"))))).alias("known_hyphens"))
    return reconcile.blocks(rows, reconcile.segmented(facts), known)


@query("SELECT * FROM (VALUES ('heading', '6.1 What is a Game?', '6.1'), ('paragraph', 'Players choose strategies in a network and receive payoffs, see Figure 6.1.', NULL), ('paragraph', 'The well-known case has 2 players and 4 outcomes [12].', NULL), ('caption', 'Figure 6.1: A small game.', '6.1'), ('paragraph', 'After the game, the players part.', NULL), ('footnote', '1 A note about the game.', NULL)) AS t(type, text, label)")
def reconciled_blocks(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark).select("type", "text", "label")


@query("SELECT '6.1' AS label, 'A small game.' AS caption, 'figure' AS label_kind, 178.0::DOUBLE AS y0, 242.0::DOUBLE AS y1")
def caption_bind(spark: SparkSession, d: str) -> DataFrame:
    grid = layout.matrices(samples.lines(spark), PAGE).select(*PAGE, F.lit(900).alias("block_no"), F.lit("matrix").alias("type"), "x0", F.lit(178.0).alias("y0"), "x1", F.lit(242.0).alias("y1"))
    blank = F.lit(None).cast("string")
    both = _blocks(spark).select(*PAGE, "block_no", "type", "label", "label_kind", "caption", "x0", "y0", "x1", "y1").unionByName(grid.withColumns({"label": blank, "label_kind": blank, "caption": blank}))
    return reconcile.bound_captions(both).select("label", "caption", "label_kind", "y0", "y1")


@query("SELECT * FROM (VALUES ('chapter', 'Chapter 3', 'chapter-3'), ('figure', 'Figure 6.1', 'fig-6-1'), ('citation', '12', 'bibliography#ref-12'), ('equation', 'Equation 2.4', 'eq-2-4')) AS t(kind, label, target)")
def cross_references(spark: SparkSession, d: str) -> DataFrame:
    b = spark.createDataFrame([(1, "See Chapter 3, Figure 6.1 [12] and Equation (2.4).")], "id int, text string")
    return reconcile.references(b, ["id"]).select("kind", "label", "target")


@query("SELECT * FROM (VALUES (1, 1.0::DOUBLE), (2, 0.944444::DOUBLE), (3, NULL)) AS t(id, agreement)")
def indel_agreement(spark: SparkSession, d: str) -> DataFrame:
    """One block as an extractor has it, one with letters off, one that no extractor has."""
    block = lambda i, t, y: ("b", 1, 1, i, "paragraph", t, 0.0, y, 100.0, y + 10.0)
    bs = spark.createDataFrame([block(1, "equal text", 0.0), block(2, "abcdefghi", 50.0), block(3, "alone", 200.0)], "book_id string, chapter int, page int, id long, type string, text string, x0 double, y0 double, x1 double, y1 double")
    rs = spark.createDataFrame([("b", 1, 1, 1, "marker", "Equal  text", 0.0, 0.0, 100.0, 10.0), ("b", 1, 1, 2, "marker", "abcdefghx", 0.0, 50.0, 100.0, 60.0), ("b", 1, 1, 3, "docling", "abcdefghi", 0.0, 50.0, 100.0, 60.0)], "book_id string, chapter int, page int, id long, source string, text string, x0 double, y0 double, x1 double, y1 double")
    return reconcile.agreement(bs, rs, ("marker", "docling")).select(F.col("id").cast("int").alias("id"), F.round("agreement", 6).alias("agreement"))


@query("SELECT * FROM (VALUES ('preface', '0', 'Preface', 'xi'), ('part', 'I', 'Graph Theory', '21'), ('chapter', '1', 'Overview', '1'), ('section', '5.5', 'A Long Title of Many Words in Print', '239'), ('chapter', '3', 'Paths and Cycles', '45')) AS t(kind, number, title, printed_page)")
def contents_entries(spark: SparkSession, d: str) -> DataFrame:
    texts = ["Preface    xi", "I   Graph Theory    21", "1  Overview     1", "5.5 A Long Title of Many Words", "in Print  . . . 239", "Chapter 3: Paths and Cycles    45", "CONTENTS"]
    ls = spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)], "book_id string, line_no int, text string")
    return contents.entries(contents.joined_entries(ls)).select("kind", "number", "title", "printed_page")


@query("SELECT * FROM (VALUES (1, 10), (2, 30)) AS t(number, pdf_page)")
def chapter_starts(spark: SparkSession, d: str) -> DataFrame:
    c = spark.createDataFrame([("b", 10, "Chapter 1 Overview"), ("b", 11, "Overview"), ("b", 30, "Graphs"), ("b", 31, "Something else")], "book_id string, page int, candidate string")
    t = spark.createDataFrame([("b", 1, "Overview"), ("b", 2, "Graphs")], "book_id string, number int, title string")
    return contents.chapter_starts(c, t).select("number", "pdf_page")


@query("SELECT * FROM (VALUES (1, 'First entry goes on.'), (2, 'Second, again.')) AS t(number, text)")
def bibliography(spark: SparkSession, d: str) -> DataFrame:
    rows = [("b", 1, 1, "References"), ("b", 1, 2, "[1] First entry"), ("b", 1, 3, "goes on."), ("b", 1, 4, "[2] Second."), ("b", 2, 1, "[2] Second, again.")]
    return emit.bibliography(spark.createDataFrame(rows, "book_id string, page int, line_no int, text string")).select("number", "text")


@query("SELECT * FROM (VALUES (1, 'As in [Section 2.1](/p/02-graphs#sec-2-1) &lt;x&gt; and [[7](/bibliography#ref-7)].'), (2, 'Figure 9.9 and the interval [0, 1].')) AS t(id, text)")
def linked_references(spark: SparkSession, d: str) -> DataFrame:
    texts = spark.createDataFrame([("b", 1, "As in Section 2.1 <x> and [7]."), ("b", 2, "Figure 9.9 and the interval [0, 1].")], "book_id string, id int, text string")
    places = spark.createDataFrame([("b", "Section", "2.1", "p/02-graphs", "sec-2-1")], "book_id string, kind string, label string, path string, anchor string")
    known = spark.createDataFrame([("b", 1), ("b", 7)], "book_id string, number int")
    return emit.linked(texts, places, known, ["book_id"])[0].select("id", "text")


@query("SELECT * FROM (VALUES ('Figure 9.9', 'target_not_emitted')) AS t(label, reason)")
def unresolved_references(spark: SparkSession, d: str) -> DataFrame:
    texts = spark.createDataFrame([("b", 2, "Figure 9.9 and the interval [0, 1].")], "book_id string, id int, text string")
    places = spark.createDataFrame([], "book_id string, kind string, label string, path string, anchor string")
    known = spark.createDataFrame([("b", 1)], "book_id string, number int")
    return emit.linked(texts, places, known, ["book_id"])[1].select("label", "reason")


@query("SELECT 6 AS chapter, '---' || chr(10) || 'id: games' || chr(10) || '---' || chr(10) || chr(10) || '# 6. Games' || chr(10) || chr(10) || '## 6.1 What is a Game? {#sec-6-1}' || chr(10) || chr(10) || 'Players choose strategies in a network and receive payoffs, see Figure 6.1.' || chr(10) || chr(10) || 'The well-known case has 2 players and 4 outcomes [12].' || chr(10) || chr(10) || 'After the game, the players part.' || chr(10) || chr(10) || '> 1 A note about the game.' || chr(10) AS markdown")
def chapter_markdown(spark: SparkSession, d: str) -> DataFrame:
    b = _blocks(spark).withColumns({c: F.lit(None).cast("string") for c in ("alt", "asset", "latex")}).withColumn("cells", F.array().cast("array<array<string>>"))
    placed = emit.block_markdown(reconcile.reading_order(b, PAGE)).withColumn("place", F.struct("page", "place"))
    titles = spark.createDataFrame([("book", 6, "Games")], "book_id string, chapter int, title string")
    return emit.pages(placed, titles).select("chapter", "markdown")


@query("SELECT * FROM (VALUES ('Chapter', '6', 'p/06-games', 'chapter-6'), ('Section', '6.1', 'p/06-games', 'sec-6-1'), ('Figure', '6.1', 'p/06-games', 'fig-6-1')) AS t(kind, label, path, anchor)")
def reference_registry(spark: SparkSession, d: str) -> DataFrame:
    ch = spark.createDataFrame([("b", 6, "p/06-games")], "book_id string, number int, path string")
    sec = spark.createDataFrame([("b", 6, "6.1")], "book_id string, chapter int, label string")
    assets = spark.createDataFrame([("b", 6, "6.1", "figure", None), ("b", 6, "6.2", "figure", "no_bbox")], "book_id string, chapter int, label string, label_kind string, issue string")
    eq = spark.createDataFrame([("b", 6, None)], "book_id string, chapter int, label string")
    return emit.registry(ch, sec, assets, eq).select("kind", "label", "path", "anchor")


@query("SELECT 'b' AS book_id, 0.06::DOUBLE AS header_zone, 0.94::DOUBLE AS folio_zone, '#|proc. #' AS keys, 9.0::DOUBLE AS body_size")
def furniture_zones(spark: SparkSession, d: str) -> DataFrame:
    """Three pages with a head, a line of text, a note that recurs and a folio."""
    rows = []
    for p in (1, 2, 3):
        rows += [("b", p, 1, f"Head {p}", 9.0, 40.0, 50.0), ("b", p, 2, "text", 10.0, 300.0, 310.0), ("b", p, 3, "more", 10.0, 320.0, 330.0), ("b", p, 4, f"Proc. {p}", 8.0, 900.0, 910.0), ("b", p, 5, str(p), 9.0, 950.0, 960.0)]
    ls = spark.createDataFrame(rows, "book_id string, page int, line_no int, text string, size double, y0 double, y1 double").withColumn("page_height", F.lit(1000.0))
    f = aggregates.furniture(ls)
    return f.select("book_id", F.round("header_zone", 6).alias("header_zone"), F.round("folio_zone", 6).alias("folio_zone"), F.array_join("boilerplate_keys", "|").alias("keys"), "body_size")


@query("SELECT * FROM (VALUES (2, 'Text', 'a b'), (2, 'Figure', '')) AS t(page, kind, text)")
def extractor_tree(spark: SparkSession, d: str) -> DataFrame:
    tree = '{"id":"/doc","block_type":"Document","children":[{"id":"/page/1/Page/0","block_type":"Page","bbox":[0,0,9,9],"children":[{"id":"/page/1/Text/1","block_type":"Text","bbox":[0,0,1,1],"html":"<p>a  <b>b</b></p>"},{"id":"x","block_type":"Figure","bbox":[1,1,2,2]}]}]}'
    return readers.tree_regions(spark.createDataFrame([("b", 1, tree)], "book_id string, chapter int, json string")).select("page", "kind", "text")


@query("SELECT * FROM (VALUES (1, 'text', 692.0::DOUBLE, 702.0::DOUBLE), (2, 'text', 10.0::DOUBLE, 20.0::DOUBLE), (1, 'picture', 5.0::DOUBLE, 6.0::DOUBLE)) AS t(page, kind, y0, y1)")
def provenance_regions(spark: SparkSession, d: str) -> DataFrame:
    box = lambda t, b, o: f'{{"l":0,"t":{t},"r":9,"b":{b},"coord_origin":"{o}"}}'
    doc = f'{{"texts":[{{"label":"text","text":"x","self_ref":"#1","prov":[{{"page_no":1,"bbox":{box(100, 90, "BOTTOMLEFT")}}},{{"page_no":2,"bbox":{box(10, 20, "TOPLEFT")}}}]}}],"pictures":[{{"label":"picture","prov":[{{"page_no":1,"bbox":{box(5, 6, "TOPLEFT")}}}]}}]}}'
    return readers.provenance_regions(spark.createDataFrame([("b", 1, doc)], "book_id string, chapter int, json string")).select("page", "kind", "y0", "y1")


@query("SELECT * FROM (VALUES ('marker', '0.8', 1::BIGINT)) AS t(source, number, missing)")
def lost_numbers(spark: SparkSession, d: str) -> DataFrame:
    """One direction only: what we have and the extractor hasn't is no loss."""
    ours = spark.createDataFrame([("b", "we have 3 and 5")], "book_id string, text string")
    theirs = spark.createDataFrame([("b", "marker", "3 and . 8")], "book_id string, source string, text string")
    return reconcile.lost_numbers(ours, theirs, ["book_id"]).select("source", "number", "missing")


@query(r"""SELECT * FROM (VALUES (1, 'a < b \tag{14.1}', '14.1', 'eq-14-1'), (2, 'x \tag{2.3}', '2.3', 'eq-2-3'), (3, '\text{words only} \tag{1.2}', '1.2', 'eq-1-2'), (6, 'y', NULL, NULL)) AS t(id, latex, label, anchor)""")
def equation_parse(spark: SparkSession, d: str) -> DataFrame:
    """A label behind a quad, one of its own, words with one; prose, several formulas in a table and broken LaTeX are left out."""
    h = [
        (1, r"<p><math>a &lt; b \quad (14.1)</math></p>"), (2, "<table><math>x</math><td><math>(2.3)</math></td></table>"), (3, "<p>words only, (1.2)</p>"),
        (4, "<p>where <math>x</math> holds</p>"), (5, "<table><math>x</math><math>y</math></table>"), (6, "<math>y</math>"), (7, r"<math>\begin{array}{c}</math>"), (8, "<p>no label</p>"),
    ]
    return equations.equations(spark.createDataFrame(h, "id int, html string"), ["id"])


@query("SELECT 6 AS chapter, '6.1' AS figures, '6.1' AS sections, 2 AS exercises, 1 AS footnotes")
def structural_census(spark: SparkSession, d: str) -> DataFrame:
    """The literal book, with exercises behind their heading: 1, 2, then 9, which isn't the next one."""
    rows, _ = _facts(spark)
    more = [("book", 6, 3, 1, "6.9 Exercises", 14.0, 50.0), ("book", 6, 3, 2, "1. Show that", 10.0, 80.0), ("book", 6, 3, 3, "2. Explain", 10.0, 95.0), ("book", 6, 3, 4, "9. No exercise", 10.0, 110.0), ("book", 6, 1, 99, "7. before the heading", 10.0, 70.0)]
    extra = spark.createDataFrame(more, "book_id string, chapter int, page int, id long, text string, size double, y0 double").withColumn("page_height", F.lit(792.0))
    s = equations.structures(rows.select(extra.columns).unionByName(extra), F.lit(10.0))
    return s.select("chapter", F.array_join("figures", ",").alias("figures"), F.element_at("sections", 1).alias("sections"), "exercises", "footnotes")


@query("SELECT * FROM (VALUES (0, 'Preface', 7, 9, 0), (1, 'Overview', 10, 14, 1), (2, 'Graphs', 16, 17, 2)) AS t(number, title, pdf_page, pdf_page_end, part)")
def boundary_map(spark: SparkSession, d: str) -> DataFrame:
    """A preface and two chapters; the divider of the next part ends the first one early, the index the last one."""
    toc = [(1, "I   First    1"), (2, "1  Overview     2"), (3, "II   Second    7"), (4, "2  Graphs     8")]
    big = [(7, "Preface"), (10, "Overview"), (16, "III. Graphs"), (18, "Index")]
    ls = [("b", p, 1, t, 20.0) for p, t in big] + [("b", p, n, "text", 10.0) for p in range(7, 20) for n in range(2, 6)]
    lines = spark.createDataFrame(ls, "book_id string, page int, line_no int, text string, size double")
    contents_lines = spark.createDataFrame([("b", n, t) for n, t in toc], "book_id string, line_no int, text string")
    found = contents.boundary_map(lines, contents_lines)
    return found.select("number", "title", "pdf_page", "pdf_page_end", F.coalesce("part", F.lit(0)).alias("part"))
