"""Queries of operators on books over the generated tables: lines, boxes, blocks and references are worked out of keys and texts.

The twins say the same in SQL from the same tables, so each result is checked over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.functions import kernel, markdown
from collatio.operators import aggregates, contents, emit, equations, gates, geometry, multiset, reconcile
from collatio.plans import tables, text
from collatio.plans.registry import query
from collatio.session import table

# Words and forms of texts


@query(r"""WITH l AS (SELECT o_orderkey, [CAST(o_custkey % 50 AS VARCHAR), CAST(o_orderkey % 97 AS VARCHAR), '3.5', '-4', CASE WHEN o_orderkey % 3 = 0 THEN 'word' ELSE CAST(o_orderkey % 7 AS VARCHAR) END, CAST(o_orderkey % 11 AS VARCHAR), CASE WHEN o_custkey % 5 = 0 THEN 'end.' ELSE '8' END, '9'] AS f FROM orders),
b AS (SELECT *, list_filter(f, lambda x: x NOT IN ('word', 'end.')) AS b FROM l)
SELECT o_orderkey FROM b WHERE NOT list_contains(f, 'end.') AND len(b) >= 0.8 * len(f) AND list_max(list_transform(list_distinct(b), lambda v: len(list_filter(b, lambda x: x = v)))) <= 0.5 * len(b)""")
def integer_soup_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of numbers, some with a word among them, some with a sentence's end."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    fields = F.concat_ws(" ", c % 50, k % 97, F.lit("3.5"), F.lit("-4"), F.when(k % 3 == 0, "word").otherwise((k % 7).cast("string")), k % 11, F.when(c % 5 == 0, "end.").otherwise("8"), F.lit("9"))
    return table(spark, d, "orders").where(kernel.is_integer_soup(fields)).select("o_orderkey")


@query(f"SELECT doc_id, CAST(len({text.tokens_sql('nfc_normalize(text)')}) AS BIGINT) AS n_tokens, array_to_string({text.tokens_sql('nfc_normalize(text)')}[1:5], ' ') AS head FROM documents")
def exact_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = kernel.tokens_of(kernel.exact_normal(F.col("text")))
    return text.documents(spark, d).select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.array_join(F.slice(t, 1, 5), " ").alias("head"))


@query(f"SELECT conv_id, token, count(*) AS n FROM (SELECT conv_id, unnest({text.tokens_sql('text')}) AS token FROM conversations WHERE role IN ('user', 'assistant')) GROUP BY ALL")
def bag_union(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    bags = [multiset.bag(c.where(F.col("role") == r), kernel.tokens(F.col("text")), ["conv_id"]) for r in ("user", "assistant")]
    return multiset.union(*bags, keys=["conv_id"]).select("conv_id", "token", "n")


@query(r"SELECT l_orderkey, l_linenumber, regexp_replace(t, '([\t\n ( ])\.[\t\n ]+([0-9])', '\1.\2', 'g') AS v FROM (SELECT l_orderkey, l_linenumber, 'at . ' || CAST(l_partkey AS VARCHAR) || ' or (.  ' || CAST(l_suppkey AS VARCHAR) || ') of .' || CAST(l_linenumber AS VARCHAR) || ' end. ' || CAST(l_linenumber AS VARCHAR) AS t FROM lineitem)")
def spaced_decimals(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.lit("at . "), F.col("l_partkey").cast("string"), F.lit(" or (.  "), F.col("l_suppkey").cast("string"), F.lit(") of ."), F.col("l_linenumber").cast("string"), F.lit(" end. "), F.col("l_linenumber").cast("string"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", kernel.repair_decimals(t).alias("v"))


@query("SELECT o_orderkey, 'ch' || lpad(CAST(o_custkey % 40 AS VARCHAR), 2, '0') AS id, CASE WHEN o_custkey % 40 = 0 AND o_orderkey % 13 BETWEEN 1 AND 10 THEN ['i', 'ii', 'iii', 'iv', 'v', 'vi', 'vii', 'viii', 'ix', 'x'][CAST(o_orderkey % 13 AS INT)] ELSE CAST(o_orderkey % 13 AS VARCHAR) END AS page FROM orders")
def chapter_ids(spark: SparkSession, d: str) -> DataFrame:
    n, c = F.col("o_orderkey") % 13, F.col("o_custkey") % 40
    return table(spark, d, "orders").select("o_orderkey", kernel.chapter_id(c).alias("id"), kernel.printed_page(n, c).alias("page"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_type ELSE CAST(p_partkey % 5 AS VARCHAR) || '. ' || p_type END AS title FROM part")
def display_titles_of_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", kernel.display_title(F.col("p_partkey") % 5, F.col("p_type")).alias("title"))


@query(r"WITH s AS (SELECT page_id, trim(regexp_replace(regexp_replace(list_last(string_split(url || '-part_' || page_id || '.pdf', '/')), '\.[^.]*$', ''), '[-_]+', ' ', 'g')) AS s FROM pages) SELECT page_id, array_to_string(list_transform(string_split(s, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM s")
def file_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", kernel.title_from_file(F.concat("url", F.lit("-part_"), "page_id", F.lit(".pdf"))).alias("title"))


FIRST_SQL = "WITH f AS (SELECT doc_id, string_split(text, chr(10))[1] AS line FROM documents WHERE text IS NOT NULL)"


def first_lines(spark: SparkSession, d: str) -> DataFrame:
    return text.documents(spark, d).where("text is not null").select("doc_id", F.split("text", "\n")[0].alias("line"))


@query(rf"{FIRST_SQL} SELECT doc_id, replace(trim(regexp_replace(line || ' | a', '{text.WS}+', ' ', 'g')), '|', '\|') AS cell FROM f")
def clean_cells(spark: SparkSession, d: str) -> DataFrame:
    return first_lines(spark, d).select("doc_id", kernel.clean_cell(F.concat("line", F.lit(" | a"))).alias("cell"))


@query(rf"""WITH s AS (SELECT p_partkey, '$' || CASE WHEN p_partkey % 3 = 0 THEN '\begin{{a}}' ELSE '{{' END || p_type || CASE WHEN p_partkey % 2 = 0 THEN '}}' ELSE '\end{{a}}' END AS s FROM part)
SELECT p_partkey, length(regexp_replace(s, '[^{{]', '', 'g')) <> length(regexp_replace(s, '[^}}]', '', 'g')) OR (contains(s, '\begin{{') AND NOT contains(s, '\end{{')) AS bad FROM s""")
def latex_of_parts(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("p_partkey")
    s = F.concat(F.lit("$"), F.when(p % 3 == 0, "\\begin{a}").otherwise("{"), F.col("p_type"), F.when(p % 2 == 0, "}").otherwise("\\end{a}"))
    return table(spark, d, "part").select("p_partkey", kernel.malformed_latex(s).alias("bad"))


@query(r"SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'x = ' || p_size ELSE 'x = ' || p_size || ' \tag{' || p_size || '.' || p_partkey % 9 || '}' END AS latex, '\text{' || regexp_replace(trim(p_type), ' +', ' ', 'g') || '}' || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '\tag{' || p_size || '.' || p_partkey % 9 || '}' END AS words FROM part")
def equation_tags(spark: SparkSession, d: str) -> DataFrame:
    label = F.concat(F.col("p_size"), F.lit("."), F.col("p_partkey") % 9)
    some = F.col("p_partkey") % 3 != 0
    latex = F.concat(F.lit("x = "), F.col("p_size"), F.when(some, F.concat(F.when(F.col("p_partkey") % 2 == 0, " \\quad (").otherwise("  ("), label, F.lit(") "))).otherwise(""))
    return table(spark, d, "part").select("p_partkey", kernel.tagged_equation(latex).alias("latex"), kernel.textual_equation(F.col("p_type"), F.when(some, label)).alias("words"))


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS INT) AS VARCHAR) || ', -0.' || CAST(l_partkey % 10 AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN ', 0.' || CAST(l_suppkey % 10 AS VARCHAR) ELSE '' END AS cell FROM lineitem")
def payoff_forms(spark: SparkSession, d: str) -> DataFrame:
    cell = F.concat(F.lit("+"), F.col("l_quantity").cast("int"), F.lit(" ,−."), F.col("l_partkey") % 10, F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(" , ."), F.col("l_suppkey") % 10)).otherwise(""))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", kernel.canonical_payoff(cell).alias("cell"))


# References, contents, links

SENTENCES_SQL = "t AS (SELECT o_orderkey AS id, CAST(o_orderkey % 3 AS INT) AS book, CAST(o_custkey % 12 + 1 AS INT) AS a, CAST(o_orderkey % 7 + 1 AS INT) AS b, CAST(o_custkey % 30 + 1 AS INT) AS n FROM orders)"


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    t = table(spark, d, "orders").select(k.alias("id"), (k % 3).cast("int").alias("book"), (c % 12 + 1).cast("int").alias("a"), (k % 7 + 1).cast("int").alias("b"), (c % 30 + 1).cast("int").alias("n"))
    return t.withColumn("text", F.concat(F.lit("As Section "), "a", F.lit("."), "b", F.lit(" says, and Chapter "), "a", F.lit(", x < y ["), "n", F.lit("].")))


@query(f"""WITH {SENTENCES_SQL} SELECT id, 0 AS place, 'citation' AS kind, CAST(n AS VARCHAR) AS label, 'bibliography#ref-' || n AS target FROM t
UNION ALL SELECT id, 1, 'section', 'Section ' || a || '.' || b, 'sec-' || a || '-' || b FROM t UNION ALL SELECT id, 2, 'chapter', 'Chapter ' || a, 'chapter-' || a FROM t""")
def references_of_orders(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.references(_sentences(spark, d), ["id"])


def _places(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Sections whose numbers add up to an even one, and bibliographies of every second or third number, for each book."""
    s = _sentences(spark, d).where("(a + b) % 2 = 0").select("book", F.lit("Section").alias("kind"), F.concat("a", F.lit("."), "b").alias("label"), F.concat(F.lit("book"), "book", F.lit("/"), "a").alias("path"), F.concat(F.lit("sec-"), "a", F.lit("-"), "b").alias("anchor")).distinct()
    return s, _sentences(spark, d).where("n % (book + 2) = 0").select("book", F.col("n").alias("number")).distinct()


@query(f"""WITH {SENTENCES_SQL} SELECT id, book, 'As ' || CASE WHEN (a + b) % 2 = 0 THEN '[Section ' || a || '.' || b || '](/book' || book || '/' || a || '#sec-' || a || '-' || b || ')' ELSE 'Section ' || a || '.' || b END
|| ' says, and Chapter ' || a || ', x &lt; y [' || CASE WHEN n % (book + 2) = 0 THEN '[' || n || '](/bibliography#ref-' || n || ')' ELSE CAST(n AS VARCHAR) END || '].' AS text FROM t""")
def linked_texts(spark: SparkSession, d: str) -> DataFrame:
    """References and citations as links, each book by its own places and entries."""
    places, entries = _places(spark, d)
    return emit.linked(_sentences(spark, d).select("book", "id", "text"), places, entries, ["book"])[0].select("id", "book", "text")


@query(f"WITH {SENTENCES_SQL} SELECT book, 'target_not_emitted' AS reason, CAST(sum(1 + CASE WHEN (a + b) % 2 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS n FROM t GROUP BY book")
def unresolved_by_reason(spark: SparkSession, d: str) -> DataFrame:
    places, entries = _places(spark, d)
    unresolved = emit.linked(_sentences(spark, d).select("book", "id", "text"), places, entries, ["book"])[1]
    return equations.by_reason(unresolved, ["book"])


CONTENTS_SQL = "c AS (SELECT CAST(p_partkey % 40 AS INT) AS book, p_partkey, CAST(p_size % 20 + 1 AS VARCHAR) || '.' || CAST(p_partkey % 9 + 1 AS VARCHAR) AS number, p_type, p_partkey % 500 + 1 AS page FROM part)"


@query(f"WITH {CONTENTS_SQL} SELECT book, 'section' AS kind, number, p_type || CASE WHEN p_partkey % 3 = 0 THEN ' 2 Players' WHEN p_partkey % 3 = 1 THEN ' and More' ELSE '' END AS title, CAST(page AS VARCHAR) AS printed_page FROM c")
def contents_of_parts(spark: SparkSession, d: str) -> DataFrame:
    """Entries of forty contents: some on one line, some that wrap, some whose second line looks like an entry."""
    p = table(spark, d, "part").select((F.col("p_partkey") % 40).cast("int").alias("book_id"), "p_partkey", F.concat(F.col("p_size") % 20 + 1, F.lit("."), F.col("p_partkey") % 9 + 1, F.lit(" "), "p_type").alias("head"), F.concat(F.lit("    "), F.col("p_partkey") % 500 + 1).alias("page"))
    rest = F.when(F.col("p_partkey") % 3 == 0, "2 Players").when(F.col("p_partkey") % 3 == 1, "and More")
    lines = F.when(rest.isNull(), F.array(F.concat("head", "page"))).otherwise(F.array(F.col("head"), F.concat(rest, F.col("page"))))
    rows = p.select("book_id", "p_partkey", F.posexplode(lines).alias("i", "text")).select("book_id", (F.col("p_partkey") * 2 + F.col("i")).cast("int").alias("line_no"), "text")
    found = contents.entries(contents.joined_entries(rows))
    return found.select(F.col("book_id").alias("book"), "kind", "number", "title", "printed_page")


@query("SELECT CAST(p_partkey // 1000 AS INT) AS book, CAST(p_partkey % 1000 AS INT) AS number, p_type || ' ' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN ' cont ' || p_size ELSE '' END AS text FROM part")
def bibliography_of_parts(spark: SparkSession, d: str) -> DataFrame:
    """A bibliography of a thousand entries, half of them on two lines, for each thousand parts."""
    p = table(spark, d, "part").withColumn("n", (F.col("p_partkey") % 1000).cast("int"))
    rows = F.array(F.concat(F.lit("["), "n", F.lit("] "), "p_type", F.lit(" "), "p_partkey"), F.concat(F.lit("  cont "), "p_size"))
    lines = p.select((F.col("p_partkey") / 1000).cast("int").alias("book_id"), (F.col("n") / 50).cast("int").alias("page"), "n", F.posexplode(F.when(F.col("p_partkey") % 2 == 0, rows).otherwise(F.slice(rows, 1, 1))).alias("i", "text"))
    return emit.bibliography(lines.withColumn("line_no", F.col("n") * 2 + F.col("i"))).select(F.col("book_id").alias("book"), "number", "text")


@query(rf"""
WITH p AS (SELECT page_id, {text.ROUTE_SQL} AS route FROM pages), i AS (SELECT DISTINCT route, 's' || k AS anchor FROM (SELECT route, unnest(range(0, page_id % 4 + 1)) AS k FROM p)),
l AS (SELECT page_id, route, 's' || page_id % 6 AS anchor FROM p)
SELECT page_id, NOT EXISTS (SELECT 1 FROM i WHERE i.route = l.route AND i.anchor = l.anchor) AS broken FROM l""")
def anchor_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Links to anchors, of which a page has up to four, on the pages' own routes."""
    path = F.regexp_replace(F.regexp_replace("url", "^https?://[^/]+", ""), "/+$", "")
    p = table(spark, d, "pages").select("page_id", F.when(path == "", "/").otherwise(path).alias("route"))
    site = p.select("route", F.explode(F.sequence(F.lit(0), (F.col("page_id") % 4).cast("int"))).alias("k")).select("route", F.concat(F.lit("s"), "k").alias("anchor"))
    links = p.select("page_id", "route", F.concat(F.lit("s"), F.col("page_id") % 6).alias("anchor"))
    bad = gates.broken_links(links, site).select("page_id").distinct().withColumn("broken", F.lit(True))
    return p.select("page_id").join(bad, "page_id", "left").select("page_id", F.coalesce("broken", F.lit(False)).alias("broken"))


@query(rf"WITH p AS (SELECT page_id, {text.ROUTE_SQL} AS route FROM pages) SELECT count(DISTINCT route) AS routes, CAST(count(*) FILTER (WHERE page_id % 3 = 0) AS BIGINT) AS anchors FROM p")
def site_inventory(spark: SparkSession, d: str) -> DataFrame:
    path = F.regexp_replace(F.regexp_replace("url", "^https?://[^/]+", ""), "/+$", "")
    return emit.inventory(table(spark, d, "pages").select(F.when(path == "", "/").otherwise(path).alias("route"), F.when(F.col("page_id") % 3 == 0, "a").alias("anchor")))


# Boxes, blocks, pages

BOX_SQL = "b AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 50 AS DOUBLE) AS x0, CAST(l_suppkey % 20 AS DOUBLE) AS y0, CAST(l_partkey % 50 + l_quantity AS DOUBLE) AS x1, CAST(l_suppkey % 20 + l_linenumber * 5 AS DOUBLE) AS y1, CAST(l_suppkey % 20 + 4 AS DOUBLE) AS v0, CAST(l_suppkey % 20 + 4 + l_linenumber * 3 AS DOUBLE) AS v1 FROM lineitem)"


def _line_boxes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "CAST(l_partkey % 50 AS DOUBLE) x0", "CAST(l_suppkey % 20 AS DOUBLE) y0", "CAST(l_partkey % 50 + l_quantity AS DOUBLE) x1", "CAST(l_suppkey % 20 + l_linenumber * 5 AS DOUBLE) y1", "CAST(l_suppkey % 20 + 4 AS DOUBLE) v0", "CAST(l_suppkey % 20 + 4 + l_linenumber * 3 AS DOUBLE) v1")


@query(f"""WITH {BOX_SQL}, s AS (SELECT *, least(x1 - x0, y1 - y0) AS s, greatest(x1 - x0, y1 - y0) AS l FROM b)
SELECT l_orderkey, l_linenumber, round(greatest(least(y1, v1) - greatest(y0, v0), 0) / least(y1 - y0, v1 - v0), 6) AS beside, (s < 12 AND l > 12 * s) OR (s < 15 AND l > 25 * s) AS is_rule,
CASE WHEN least(x1 + 4, 60) - greatest(x0 - 4, 0) < 24 OR least(y1 + 4, 40) - greatest(y0 - 4, 0) < 24 THEN 'too_small' END AS issue FROM s""")
def box_measures(spark: SparkSession, d: str) -> DataFrame:
    box, other = ([F.col(c) for c in names] for names in (("x0", "y0", "x1", "y1"), ("x0", "v0", "x1", "v1")))
    page = [F.lit(v) for v in (0.0, 0.0, 60.0, 40.0)]
    return _line_boxes(spark, d).select("l_orderkey", "l_linenumber", F.round(geometry.vertical_overlap(box, other), 6).alias("beside"), geometry.is_rule(box).alias("is_rule"), geometry.asset_issue(box, page).alias("issue"))


@query(f"WITH {BOX_SQL} SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY y0, x0, l_linenumber) AS INT) AS place FROM b")
def reading_order_of_boxes(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.reading_order(_line_boxes(spark, d).withColumn("block_no", F.col("l_linenumber")), ["l_orderkey"]).select("l_orderkey", "l_linenumber", "place")


@query("SELECT l_orderkey, l_linenumber, 'ch' || lpad(CAST(c AS VARCHAR), 2, '0') || '-b' || CASE WHEN r < 10000 THEN lpad(CAST(r AS VARCHAR), 4, '0') ELSE CAST(r AS VARCHAR) END AS id FROM (SELECT l_orderkey, l_linenumber, l_orderkey % 90 AS c, row_number() OVER (PARTITION BY l_orderkey % 90 ORDER BY l_orderkey, l_linenumber) AS r FROM lineitem)")
def block_ids_of_lines(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.lit(1).alias("book_id"), (F.col("l_orderkey") % 90).cast("int").alias("chapter"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("block_no"))
    return reconcile.block_ids(b).select("l_orderkey", "l_linenumber", "id")


TYPES = ("figure", "table", "heading", "equation", "exercise", "footnote", "matrix")
BLOCKS_SQL = "b AS (SELECT CAST(l_orderkey % 60 AS INT) AS chapter, CAST(l_orderkey AS INT) AS page, ['figure', 'table', 'heading', 'equation', 'exercise', 'footnote', 'matrix'][l_linenumber] AS type, CAST(l_partkey % 30 AS VARCHAR) AS label, CASE WHEN l_suppkey % 3 = 0 THEN 'table' ELSE 'figure' END AS label_kind FROM lineitem)"


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, TYPES)), F.col("l_linenumber").cast("int"))
    return table(spark, d, "lineitem").select(F.lit(1).alias("book_id"), (F.col("l_orderkey") % 60).cast("int").alias("chapter"), F.col("l_orderkey").cast("int").alias("page"), kind.alias("type"), (F.col("l_partkey") % 30).cast("string").alias("label"), F.when(F.col("l_suppkey") % 3 == 0, "table").otherwise("figure").alias("label_kind"))


@query(f"""WITH {BLOCKS_SQL} SELECT chapter, coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE type IN ('figure', 'matrix') AND label_kind <> 'table'))), ','), '') AS figures,
coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE type IN ('figure', 'matrix', 'table') AND label_kind = 'table'))), ','), '') AS tables, CAST(count(*) FILTER (WHERE type = 'exercise') AS INT) AS exercises, CAST(count(*) FILTER (WHERE type = 'matrix') AS INT) AS matrices FROM b GROUP BY chapter""")
def model_structure(spark: SparkSession, d: str) -> DataFrame:
    m = equations.model_counts(_blocks(spark, d))
    return m.select("chapter", F.array_join("figures", ",").alias("figures"), F.array_join("tables", ",").alias("tables"), "exercises", "matrices")


@query(f"WITH {BLOCKS_SQL} SELECT DISTINCT chapter, page FROM b WHERE type = 'matrix' AND label_kind = 'table'")
def pages_with_flags(spark: SparkSession, d: str) -> DataFrame:
    flags = F.when((F.col("type") == "matrix") & (F.col("label_kind") == "table"), F.array(F.lit("odd"))).otherwise(F.array().cast("array<string>"))
    return equations.flagged_pages(_blocks(spark, d).withColumn("flags", flags)).select("chapter", "page")


@query("SELECT p_partkey, CASE WHEN p_size % 7 = 0 AND p_type LIKE 'S%' THEN 'fixed ' || p_type ELSE p_type END AS latex FROM part")
def corrected_equations(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").alias("page"), F.col("p_type").alias("latex"))
    fixes = p.where("page % 7 = 0 and latex like 'S%'").select("page", "latex", F.concat(F.lit("fixed "), "latex").alias("replacement")).distinct()
    return equations.corrected(p, fixes).select("p_partkey", "latex")


@query("SELECT o_orderkey, arg_max('f' || l_partkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey) AS asset FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_quantity > 10) ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def last_assets(spark: SparkSession, d: str) -> DataFrame:
    """Each block's last asset that has no issue."""
    key = [F.lit(1).alias("book_id"), F.lit(1).alias("chapter")]
    blocks = table(spark, d, "orders").select(*key, F.col("o_orderkey").alias("id"))
    assets = table(spark, d, "lineitem").select(*key, F.col("l_orderkey").alias("block"), F.concat(F.lit("f"), "l_partkey").alias("file"), (F.col("l_linenumber") * F.lit(1000000000).cast("long") + F.col("l_partkey")).alias("n"), F.when(F.col("l_quantity") <= 10, "small").alias("issue"))
    return equations.with_assets(blocks, assets).select(F.col("id").alias("o_orderkey"), "asset")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS r FROM events) WHERE r % (user_id % 3 + 2) = 0")
def strided_by_key(spark: SparkSession, d: str) -> DataFrame:
    return multiset.strided(table(spark, d, "events").select("user_id", "event_id"), ["event_id"], F.col("user_id") % 3 + 2, ["user_id"]).select("user_id", "event_id")


# Gates and reports


@query(rf"""
WITH l AS ({text.LINES_SQL}), m AS (SELECT l.*, lang, {text.MASK_SQL} AS mask FROM l JOIN documents USING (doc_id)), k AS (SELECT mask FROM m GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3),
f AS (SELECT m.lang, m.line, m.line_no, k.mask IS NOT NULL AS known, list_filter(regexp_split_to_array(line, '{text.WS}+'), lambda x: x <> '') AS f FROM m LEFT JOIN k USING (mask)),
b AS (SELECT *, list_filter(f, lambda x: regexp_full_match(x, '[-\x{{2212}}]?\p{{Nd}}+(?:\.\p{{Nd}}+)?')) AS b FROM f),
r AS (SELECT lang, CASE WHEN known THEN 'boilerplate' WHEN line_no = 1 AND length(line) < 40 THEN 'chapter_opener_heading'
  WHEN len(f) >= 6 AND NOT regexp_matches(line, '[.!?;:]{text.WS}') AND len(b) >= 0.8 * len(f) AND list_max(list_transform(list_distinct(b), lambda v: len(list_filter(b, lambda x: x = v)))) <= 0.5 * len(b) THEN 'integer_soup' END AS reason FROM b)
SELECT lang, reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY ALL""")
def removed_by_reason(spark: SparkSession, d: str) -> DataFrame:
    """Why lines are no reference text, the first reason of each, and how many each reason takes."""
    x = text.documents(spark, d).where("doc_id is not null").select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("p", "line"))
    reason = reconcile.line_reason(F.lit(None).cast("string"), (F.col("p") == 0) & (F.length("line") < 40), F.lit(False), F.lit(False), F.col("line"))
    m = x.select("doc_id", "lang", text.key_of(kernel.mask(F.col("line"))).alias("key"), reason.alias("reason"))
    return aggregates.recurring_reasons(m, "key", "doc_id", {"chapter_opener_heading": False, "integer_soup": False}, "boilerplate", ["lang"])


@query(f"WITH {tables.GATES_SQL} SELECT '| ' || lang || ' | ' || kind || ' | ' || substr(replace(what, '|', '\\|'), 1, 180) || ' |' AS row FROM q")
def review_rows(spark: SparkSession, d: str) -> DataFrame:
    return emit.queue_markdown(tables.review_queue(spark, d), ["lang"]).select("row")


@query("""
WITH g AS (SELECT r_name, list(n_name ORDER BY n_nationkey) AS names FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name)
SELECT r_name, 0 AS row, r_name || ',nation' AS cells FROM g UNION ALL SELECT r_name, CAST(i AS INT), i || ',' || names[i] FROM (SELECT r_name, names, unnest(range(1, len(names) + 1)) AS i FROM g)""")
def table_cell_rows(spark: SparkSession, d: str) -> DataFrame:
    """The cells of the tables that `markdown_table` writes."""
    t = text.markdown_table(spark, d)
    return t.select("r_name", F.posexplode(markdown.table_cells(F.col("markdown"))).alias("row", "c")).select("r_name", "row", F.array_join("c", ",").alias("cells"))


LOST_SQL = """
u AS (SELECT o_orderkey AS k, unnest([CAST(o_custkey % 10 AS VARCHAR), CAST(o_orderkey % 7 AS VARCHAR)]) AS x FROM orders),
a AS (SELECT l_orderkey AS k, l_linenumber AS page, unnest([CAST(l_partkey % 10 AS VARCHAR), CAST(l_suppkey % 7 AS VARCHAR), '0.' || l_linenumber]) AS x FROM lineitem),
ub AS (SELECT k, x, count(*) AS n FROM u GROUP BY ALL), ab AS (SELECT k, x, count(*) AS n FROM a GROUP BY ALL),
lost AS (SELECT ab.k, ab.x, ab.n - coalesce(ub.n, 0) AS missing FROM ab LEFT JOIN ub ON ab.k = ub.k AND ab.x = ub.x WHERE ab.n > coalesce(ub.n, 0))
"""


def _lost(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """An order's own numbers against those of its lines, which have a decimal whose point stands apart."""
    ours = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.concat(F.lit("total "), F.col("o_custkey") % 10, F.lit(" and "), F.col("o_orderkey") % 7).alias("text"))
    text_ = F.concat(F.lit("part "), F.col("l_partkey") % 10, F.lit(" x "), F.col("l_suppkey") % 7, F.lit(" . "), "l_linenumber")
    theirs = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("page"), text_.alias("text"), F.lit("lines").alias("source"))
    return reconcile.lost_numbers(ours, theirs, ["k"]), theirs


@query(f"WITH {LOST_SQL} SELECT k, x AS number, CAST(missing AS BIGINT) AS missing FROM lost")
def lost_number_counts(spark: SparkSession, d: str) -> DataFrame:
    return _lost(spark, d)[0].select("k", "number", F.col("missing").cast("long").alias("missing"))


@query(f"WITH {LOST_SQL} SELECT DISTINCT k, page FROM a JOIN lost USING (k, x)")
def affected_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages of the extractor that hold a number which we lost."""
    lost, theirs = _lost(spark, d)
    return reconcile.affected_pages(lost, theirs, ["k"]).select("k", "page")


@query(f"""
WITH {text.STRIPPED_SQL},
r AS (SELECT doc_id, unnest({text.tokens_sql('text')}) AS x, generate_subscripts({text.tokens_sql('text')}, 1) AS p FROM documents), c AS (SELECT doc_id, unnest({text.tokens_sql('line')}) AS x FROM s),
rb AS (SELECT doc_id, x, count(*) AS n, min(p) AS first FROM r GROUP BY ALL), cb AS (SELECT doc_id, x, count(*) AS n FROM c GROUP BY ALL),
j AS (SELECT rb.doc_id, rb.x, first, rb.n - coalesce(cb.n, 0) AS missing FROM rb LEFT JOIN cb ON rb.doc_id = cb.doc_id AND rb.x = cb.x WHERE rb.n > coalesce(cb.n, 0)),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY first) AS place FROM j)
SELECT doc_id, CAST(place AS INT) AS place, x AS token, CAST(missing AS BIGINT) AS missing FROM k WHERE place <= 10""")
def coverage_details(spark: SparkSession, d: str) -> DataFrame:
    """The first ten words of each document that its rendering has less often."""
    docs, known = text.documents(spark, d), text.known_lines(spark, d)
    joined = F.col("text").rlike(kernel.WORDS_ACROSS)
    # Where no line end joins words, exactly the words of dropped lines are missing, and they are found within the row.
    own = text.own_lines(docs.where(~joined), known, "inner").select("doc_id", kernel.tokens(F.col("text")).alias("t"), F.flatten(F.transform("dropped", kernel.tokens)).alias("lost"))
    first = own.select("doc_id", "lost", F.slice(F.array_intersect("t", "lost"), 1, 10).alias("w")).select("doc_id", "lost", F.posexplode("w").alias("p", "token"))
    plain = first.select("doc_id", (F.col("p") + 1).alias("place"), "token", F.size(F.filter("lost", lambda x: x == F.col("token"))).cast("long").alias("missing"))
    rest = docs.where(joined)
    r = multiset.bag(rest, kernel.tokens(F.col("text")), ["doc_id"])
    kept = rest.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).withColumn("key", text.key_of(F.col("line"))).join(known, "key", "left_anti")
    c = multiset.bag(kept, kernel.tokens(F.col("line")), ["doc_id"])
    others = gates.details(multiset.difference(r, c, ["doc_id"]).where("missing > 0"), ["doc_id"], "first_pos", 10)
    return plain.unionByName(others.select("doc_id", "place", "token", F.col("missing").cast("long").alias("missing")))
