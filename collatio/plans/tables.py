"""Queries over keyed tables: aggregates that keep order, de-duplication, intervals, gates, boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from collatio.functions import kernel
from collatio.operators import aggregates, gates, geometry, multiset
from collatio.plans import text
from collatio.plans.registry import query
from collatio.session import table


@query("WITH c AS (SELECT event_type, round(value) AS v, count(*) AS n, min(event_id) AS f FROM events WHERE value IS NOT NULL GROUP BY ALL) SELECT event_type, v AS mode, n FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, f) AS r FROM c) WHERE r = 1")
def first_seen_mode(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_type", "event_id", F.round("value").alias("v"))
    return aggregates.first_seen_mode(e, "v", "event_id", ["event_type"])


@query("SELECT l_returnflag, l_linestatus, list_sort(list(l_extendedprice))[count(*) // 2 + 1] AS upper_median FROM lineitem GROUP BY ALL")
def upper_median(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.upper_median(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice"), "l_extendedprice", ["l_returnflag", "l_linestatus"])


@query("SELECT o_orderpriority, median(o_totalprice) AS median FROM orders GROUP BY o_orderpriority")
def median_extent(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.median(table(spark, d, "orders").select("o_orderpriority", "o_totalprice"), "o_totalprice", ["o_orderpriority"])


@query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS r FROM conversations) WHERE coalesce(role, '') = '' OR r = 1")
def dedup_first_by_key(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return aggregates.first_of_key(c, "role", ["turn"], ["conv_id"])


@query("SELECT doc_id, sha256(text) AS digest, same_as FROM (SELECT doc_id, text, first_value(doc_id) OVER (PARTITION BY text ORDER BY doc_id) AS same_as, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r > 1")
def duplicate_content(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.duplicates(table(spark, d, "documents").select("doc_id", "text"), F.sha2("text", 256), "doc_id")


SLUG_SQL = r"array_to_string(list_filter(regexp_split_to_array(regexp_replace(lower({}), '[^a-z0-9\s-]', '', 'g'), '\s+'), lambda x: x <> ''), '-')"


@query(f"WITH s AS (SELECT p_partkey, {SLUG_SQL.format('p_type')} AS slug FROM part), n AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY p_partkey) AS n FROM s) SELECT p_partkey, CASE WHEN n = 1 THEN slug ELSE slug || '-cont' || CAST(n AS VARCHAR) END AS name FROM n")
def repeat_slug_suffix(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.repeated_names(table(spark, d, "part").select("p_partkey", "p_type"), kernel.slug(F.col("p_type")), "p_partkey").select("p_partkey", "name")


@query("SELECT doc_id, 'left' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'right' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)")
def label_set_difference(spark: SparkSession, d: str) -> DataFrame:
    return multiset.set_difference(table(spark, d, "documents"), table(spark, d, "labels"), ["doc_id"])


@query("WITH f AS (SELECT doc_id, lang FROM documents WHERE len(text) > 3000) SELECT lang, CASE WHEN count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) = 0 THEN 'REVIEWED' ELSE 'FAIL' END AS status, CAST(count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS BIGINT) AS outstanding FROM f GROUP BY lang")
def outstanding_review(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    flagged = docs.where(F.length("text") > 3000).select("lang", F.col("doc_id").alias("page"))
    checked = table(spark, d, "labels").select(F.col("doc_id").alias("page")).join(docs.select(F.col("doc_id").alias("page"), "lang"), "page")
    g = gates.visual(flagged, checked, flagged.select("lang").distinct(), ["lang"])
    return g.select("lang", "status", F.get_json_object("detail", "$.outstanding").cast("long").alias("outstanding"))


PARTS_SQL = "p AS (SELECT DISTINCT date_trunc('quarter', o_orderdate) AS s FROM orders)"


@query(f"WITH {PARTS_SQL}, q AS (SELECT s, row_number() OVER (ORDER BY s) AS number, lead(s) OVER (ORDER BY s) AS e FROM p) SELECT o_orderkey, CAST(number AS INT) AS number FROM orders JOIN q ON o_orderdate >= s AND (e IS NULL OR o_orderdate < e)")
def interval_assign(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("year"))
    starts = o.select(F.date_trunc("quarter", "o_orderdate").alias("start")).distinct().withColumn("number", F.row_number().over(Window.orderBy("start"))).withColumn("year", F.year("start"))
    return geometry.intervals(o, starts, "o_orderdate", "start", ["year"]).select("o_orderkey", F.col("interval_number").alias("number"))


@query("WITH y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), c AS (SELECT CAST(y AS INT) AS number, CAST((y - 1990) * 10 AS INT) AS pdf_page FROM y), d AS (SELECT pdf_page + 4 AS d FROM c WHERE number % 2 = 0), n AS (SELECT *, lead(pdf_page) OVER (ORDER BY pdf_page) AS nx FROM c) SELECT number, pdf_page, CAST(coalesce(min(d), nx, 0) - 1 AS INT) AS pdf_page_end FROM n LEFT JOIN d ON d > pdf_page AND (nx IS NULL OR d < nx) GROUP BY number, pdf_page, nx")
def chapter_ends(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "orders").select(F.year("o_orderdate").alias("number")).distinct().select(F.lit(1).alias("book"), "number", ((F.col("number") - 1990) * 10).alias("pdf_page"))
    dividers = c.where("number % 2 = 0").select("book", (F.col("pdf_page") + 4).alias("pdf_page"))
    return geometry.clipped_ends(c, dividers, ["book"]).select("number", "pdf_page", F.coalesce("pdf_page_end", F.lit(-1)).alias("pdf_page_end"))


@query("WITH e AS (SELECT user_id, event_id, epoch(ts) AS t FROM events), w AS (SELECT *, max(t + 60) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM e), b AS (SELECT *, sum(CASE WHEN t - r > 86400 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS k FROM w) SELECT user_id, CAST(max(t + 60) AS BIGINT) AS extent FROM b WHERE k = 0 GROUP BY user_id")
def edge_cluster(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t")).withColumn("b", F.col("t") + 60)
    return aggregates.edge_cluster(e, ["user_id"], "t", "b", "event_id", 86400.0).select("user_id", F.round("extent").cast("long").alias("extent"))


@query("SELECT event_id, user_id FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS r FROM events) WHERE r % 40 = 0")
def strided_sample(spark: SparkSession, d: str) -> DataFrame:
    return multiset.strided_whole(table(spark, d, "events").select("event_id", "user_id"), "event_id", 40)


#: Lines of six fields or more of which four in five are bare numbers, none of them most of these, without a sentence's end.
SOUP_SQL = rf"""
sl AS (SELECT lang, line, list_filter(regexp_split_to_array(line, '{text.WS}+'), lambda x: x <> '') AS f FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents)),
sb AS (SELECT *, list_filter(f, lambda x: regexp_full_match(x, '[-\x{{2212}}]?\p{{Nd}}+(?:\.\p{{Nd}}+)?')) AS b FROM sl WHERE len(f) >= 6 AND NOT regexp_matches(line, '[.!?;:]{text.WS}')),
soup AS (SELECT lang, substr(line, 1, 160) AS what FROM sb WHERE len(b) >= 0.8 * len(f) AND list_max(list_transform(list_distinct(b), lambda v: len(list_filter(b, lambda x: x = v)))) <= 0.5 * len(b)),
"""
GATES_SQL = f"""
{SOUP_SQL}
cov AS ({text.COVERAGE_BY_LANGUAGE_SQL}), num AS ({text.NUMERIC_SQL}),
g AS (SELECT lang, 'text_coverage' AS gate, status, true AS hard FROM cov UNION ALL SELECT lang, 'numeric_fidelity', status, true FROM num
 UNION ALL SELECT lang, 'visual', CASE WHEN count(*) FILTER (WHERE len(text) > 3000 AND doc_id NOT IN (SELECT doc_id FROM labels)) = 0 THEN 'REVIEWED' ELSE 'FAIL' END, false FROM documents GROUP BY lang),
q AS (SELECT lang, CASE WHEN status = 'FAIL' THEN 'gate_failure' ELSE 'gate_blocked' END AS kind, gate AS what FROM g WHERE status IN ('FAIL', 'BLOCKED') UNION ALL SELECT lang, 'integer_soup', what FROM soup)
"""


def _gate_rows(spark: SparkSession, d: str) -> DataFrame:
    """The results of three gates by language: coverage and numbers of the documents without boilerplate, and the review of long ones."""
    coverage = text.coverage_by_language(spark, d).select("lang", F.lit("text_coverage").alias("gate"), "status", F.lit(True).alias("hard"))
    numbers = text.numeric_by_language(spark, d).select("lang", F.lit("numeric_fidelity").alias("gate"), "status", F.lit(True).alias("hard"))
    visual = outstanding_all(spark, d).select("lang", F.lit("visual").alias("gate"), "status", F.lit(False).alias("hard"))
    return coverage.unionByName(numbers).unionByName(visual)


def outstanding_all(spark: SparkSession, d: str) -> DataFrame:
    """The visual gate of every language: its long documents have to have labels."""
    docs = table(spark, d, "documents")
    flagged = docs.where(F.length("text") > 3000).select("lang", F.col("doc_id").alias("page"))
    checked = table(spark, d, "labels").select(F.col("doc_id").alias("page")).join(docs.select(F.col("doc_id").alias("page"), "lang"), "page")
    return gates.visual(flagged, checked, docs.select("lang").distinct(), ["lang"])


def _soup(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("lang", F.explode(F.split("text", "\n")).alias("text"))
    return x.where(kernel.is_integer_soup(F.col("text"))).select("lang", F.lit("integer_soup").alias("reason"), "text")


@query(f"WITH {GATES_SQL} SELECT g.lang, CASE WHEN bool_or(hard AND status = 'FAIL') THEN 'FAIL' WHEN bool_or(hard AND status = 'BLOCKED') THEN 'BLOCKED' WHEN g.lang IN (SELECT lang FROM q) THEN 'REVIEW' ELSE 'PASS' END AS status FROM g GROUP BY g.lang")
def gate_status_rollup(spark: SparkSession, d: str) -> DataFrame:
    g = _gate_rows(spark, d).cache()  # three rows a language, read twice
    return gates.chapter_status(g, gates.review_queue(_soup(spark, d), g, ["lang"]), ["lang"])


@query(f"WITH {GATES_SQL} SELECT lang, kind, what FROM q")
def review_queue(spark: SparkSession, d: str) -> DataFrame:
    return gates.review_queue(_soup(spark, d), _gate_rows(spark, d), ["lang"])


@query(f"WITH {GATES_SQL} SELECT lang, CAST(count(*) FILTER (WHERE status IN ('PASS', 'REVIEWED')) AS BIGINT) AS gates_passed, CASE WHEN bool_or(status = 'FAIL') THEN 'failing' ELSE 'in progress' END AS status FROM g GROUP BY lang")
def progress_status(spark: SparkSession, d: str) -> DataFrame:
    g = _gate_rows(spark, d).cache()  # three rows a language, read twice
    return gates.progress(g.select("lang").distinct().withColumn("started", F.lit(True)), g, ["lang"])


@query("""
WITH a AS (SELECT page_id, page_id % 7 AS chapter, url AS file, CAST(length(html) AS BIGINT) AS length, CAST(page_id % 150 + 60 AS INT) AS width, 300 AS height, CASE WHEN page_id % 11 = 0 THEN ' ' ELSE url END AS alt, sha256(html) AS sha, CASE WHEN page_id % 13 = 0 THEN 'no_bbox' END AS issue FROM pages),
f AS (SELECT *, row_number() OVER (PARTITION BY chapter, sha ORDER BY page_id) AS r FROM a WHERE issue IS NULL)
SELECT chapter, page_id, issue FROM a WHERE issue IS NOT NULL UNION ALL SELECT chapter, page_id, 'too_small' FROM f WHERE width < 100 UNION ALL SELECT chapter, page_id, 'empty_alt' FROM f WHERE trim(alt) = ''
UNION ALL SELECT chapter, page_id, 'duplicate_image' FROM f WHERE r > 1 UNION ALL SELECT chapter, -chapter - 1, 'referenced_but_absent' FROM (SELECT DISTINCT chapter FROM a)""")
def asset_problems(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages")
    a = p.select(
        (F.col("page_id") % 7).alias("chapter"), F.col("page_id").alias("label"), F.when(F.col("page_id") % 13 == 0, "no_bbox").alias("issue"), F.col("url").alias("file"), F.length("html").cast("long").alias("length"),
        (F.col("page_id") % 150 + 60).cast("int").alias("width"), F.lit(300).alias("height"), F.when(F.col("page_id") % 11 == 0, " ").otherwise(F.col("url")).alias("alt"), F.sha2("html", 256).alias("sha256"), F.col("page_id").alias("n"),
    )
    referenced = a.select("chapter", (-F.col("chapter") - 1).alias("label")).distinct()
    return gates.asset_problems(a, referenced, ["chapter"]).withColumnRenamed("label", "page_id")


BOXES = "WITH l AS (SELECT CAST(l_orderkey % 500 AS INT) AS page, ((l_orderkey * 100003 + l_partkey) * 1009 + l_suppkey) * 10 + l_linenumber AS id, CAST(l_partkey % 400 AS DOUBLE) AS x0, CAST(l_suppkey * 7 % 700 AS DOUBLE) AS y0, CAST(l_partkey % 400 + 30 + l_linenumber * 9 AS DOUBLE) AS x1, CAST(l_suppkey * 7 % 700 + 12 AS DOUBLE) AS y1 FROM lineitem), b AS (SELECT CAST(o_orderkey % 500 AS INT) AS page, o_orderkey AS id, CAST(o_custkey % 350 AS DOUBLE) AS x0, CAST(o_orderkey * 13 % 650 AS DOUBLE) AS y0, CAST(o_custkey % 350 + 60 AS DOUBLE) AS x1, CAST(o_orderkey * 13 % 650 + 25 AS DOUBLE) AS y1 FROM orders)"
OVERLAP_SQL = "greatest(least(l.x1, b.x1) - greatest(l.x0, b.x0), 0) * greatest(least(l.y1, b.y1) - greatest(l.y0, b.y0), 0) / least((l.x1 - l.x0) * (l.y1 - l.y0), (b.x1 - b.x0) * (b.y1 - b.y0))"


def _boxes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, d, "lineitem").selectExpr("CAST(l_orderkey % 500 AS INT) page", "((l_orderkey * 100003 + l_partkey) * 1009 + l_suppkey) * 10 + l_linenumber id", "CAST(l_partkey % 400 AS DOUBLE) x0", "CAST(l_suppkey * 7 % 700 AS DOUBLE) y0", "CAST(l_partkey % 400 + 30 + l_linenumber * 9 AS DOUBLE) x1", "CAST(l_suppkey * 7 % 700 + 12 AS DOUBLE) y1")
    boxes = table(spark, d, "orders").selectExpr("CAST(o_orderkey % 500 AS INT) page", "o_orderkey id", "CAST(o_custkey % 350 AS DOUBLE) x0", "CAST(o_orderkey * 13 % 650 AS DOUBLE) y0", "CAST(o_custkey % 350 + 60 AS DOUBLE) x1", "CAST(o_orderkey * 13 % 650 + 25 AS DOUBLE) y1")
    return lines, boxes


@query(f"{BOXES} SELECT l.page, l.id, b.id AS box, round({OVERLAP_SQL}, 6) AS score FROM l JOIN b ON l.page = b.page WHERE {OVERLAP_SQL} > 0.6")
def spatial_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    """Lines that lie in a box by more than 0.6."""
    lines, boxes = _boxes(spark, d)
    return geometry.overlapping_ids(lines, boxes, ["page"], 0.6, lambda s: F.round(s, 6)).select("page", "id", F.col("r_id").alias("box"), "score")


@query(f"{BOXES}, s AS (SELECT l.page, l.id, b.id AS box, {OVERLAP_SQL} AS score FROM l JOIN b ON l.page = b.page) SELECT page, id, box FROM (SELECT *, row_number() OVER (PARTITION BY page, id ORDER BY score DESC, box) AS r FROM s WHERE score > 0.5) WHERE r = 1")
def box_owner(spark: SparkSession, d: str) -> DataFrame:
    lines, boxes = _boxes(spark, d)
    return geometry.owner(lines, boxes, ["page"]).select("page", "id", F.col("r_id").alias("box"))


@query(f"{BOXES} SELECT l.page, l.id FROM l WHERE EXISTS (SELECT 1 FROM b WHERE b.page = l.page AND l.x0 >= b.x0 - 2 AND l.y0 >= b.y0 - 2 AND l.x1 <= b.x1 + 2 AND l.y1 <= b.y1 + 2)")
def box_containment(spark: SparkSession, d: str) -> DataFrame:
    lines, boxes = _boxes(spark, d)
    return geometry.enclosed(lines, boxes, ["page"]).select("page", "id")


@query("WITH p AS (SELECT CAST(l_orderkey % 500 AS INT) AS page, l_orderkey * 10 + l_linenumber AS id, CAST(l_partkey % 400 AS DOUBLE) AS x FROM lineitem), c AS (SELECT CAST(o_orderkey % 500 AS INT) AS page, o_orderkey AS k, CAST(o_custkey % 350 AS DOUBLE) AS centre FROM orders), j AS (SELECT p.page, id, k, abs(x - centre) AS dist FROM p JOIN c ON p.page = c.page AND abs(x - centre) < 26) SELECT page, id, k AS \"column\" FROM (SELECT *, row_number() OVER (PARTITION BY page, id ORDER BY dist, k) AS r FROM j) WHERE r = 1")
def nearest_column(spark: SparkSession, d: str) -> DataFrame:
    points = table(spark, d, "lineitem").selectExpr("CAST(l_orderkey % 500 AS INT) page", "l_orderkey * 10 + l_linenumber id", "CAST(l_partkey % 400 AS DOUBLE) x")
    centres = table(spark, d, "orders").selectExpr("CAST(o_orderkey % 500 AS INT) page", "o_orderkey column", "CAST(o_custkey % 350 AS DOUBLE) centre")
    return geometry.nearest(points, centres, ["page"]).select("page", "id", "column")


@query("SELECT l_returnflag, min(l_quantity) AS x0, min(l_discount) AS y0, max(l_quantity) AS x1, max(l_tax) AS y1 FROM lineitem GROUP BY l_returnflag")
def bbox_union(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").alias("x0"), F.col("l_discount").alias("y0"), F.col("l_quantity").alias("x1"), F.col("l_tax").alias("y1"))
    return aggregates.bbox_union(li, ["l_returnflag"])


@query("SELECT o_orderpriority, count(DISTINCT o_orderkey % 4 - o_custkey % 2) AS n_offsets, CASE WHEN count(DISTINCT o_orderkey % 4 - o_custkey % 2) = 1 THEN max(o_orderkey % 4 - o_custkey % 2) ELSE -99 END AS \"offset\" FROM orders GROUP BY o_orderpriority")
def consistent_offset(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderpriority", (F.col("o_orderkey") % 4).alias("l"), (F.col("o_custkey") % 2).alias("r"))
    return aggregates.consistent_offset(o, "l", "r", ["o_orderpriority"]).withColumn("offset", F.coalesce("offset", F.lit(-99)).cast("long"))


@query("SELECT lang, count(*) FILTER (WHERE len(text) > 2000) AS n, round(count(*) FILTER (WHERE len(text) > 2000) / count(*), 6) AS share FROM documents GROUP BY lang")
def coverage_share(spark: SparkSession, d: str) -> DataFrame:
    s = aggregates.share(table(spark, d, "documents").select("lang", "text"), F.length("text") > 2000, ["lang"])
    return s.select("lang", "n", F.round("share", 6).alias("share"))


@query("SELECT source, len(list_distinct(list(lang))) AS n_langs, array_to_string(list_sort(list_distinct(list(lang))), ',') AS langs FROM documents GROUP BY source")
def sorted_sets(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("s"))
    return g.select("source", F.size("s").cast("long").alias("n_langs"), F.array_join("s", ",").alias("langs"))


@query(r"""WITH x AS (SELECT p_partkey, CAST(p_size % 9 AS VARCHAR) || '.' || CAST(p_partkey % 13 AS VARCHAR) AS label FROM part)
SELECT p_partkey, label, CAST(row_number() OVER (ORDER BY list_transform(string_split(label, '.'), lambda z: CAST(z AS INT)), p_partkey) AS INT) AS place FROM x""")
def label_order(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "part").select("p_partkey", F.concat((F.col("p_size") % 9).cast("string"), F.lit("."), (F.col("p_partkey") % 13).cast("string")).alias("label"))
    return multiset.numbered(x.withColumn("k", kernel.label_key(F.col("label"))), ["k", "p_partkey"], ["k"], "place").select("p_partkey", "label", F.col("place").cast("int").alias("place"))


@query(r"""SELECT o_orderkey, kind || ' ' || number AS label, CASE WHEN kind <> 'Exercise' THEN CAST(split_part(number, '.', 1) AS INT) ELSE -1 END AS chapter,
CASE kind WHEN 'Chapter' THEN 'chapter-' || number WHEN 'Section' THEN 'sec-' WHEN 'Figure' THEN 'fig-' WHEN 'Table' THEN 'tbl-' WHEN 'Equation' THEN 'eq-' ELSE 'ex-' END || CASE WHEN kind = 'Chapter' THEN '' ELSE replace(number, '.', '-') END AS anchor
FROM (SELECT o_orderkey, ['Chapter', 'Section', 'Figure', 'Table', 'Equation', 'Exercise'][CAST(o_custkey % 6 + 1 AS INT)] AS kind, CAST(o_orderkey % 30 AS VARCHAR) || CASE WHEN o_custkey % 6 IN (0, 5) THEN '' ELSE '.' || CAST(o_custkey % 20 AS VARCHAR) END AS number FROM orders)""")
def reference_targets(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.array(*map(F.lit, ("Chapter", "Section", "Figure", "Table", "Equation", "Exercise")))
    o = table(spark, d, "orders").select("o_orderkey", F.element_at(kinds, (F.col("o_custkey") % 6 + 1).cast("int")).alias("kind"), F.concat((F.col("o_orderkey") % 30).cast("string"), F.when((F.col("o_custkey") % 6).isin(0, 5), "").otherwise(F.concat(F.lit("."), (F.col("o_custkey") % 20).cast("string")))).alias("number"))
    label = F.concat_ws(" ", "kind", "number")
    return o.select("o_orderkey", label.alias("label"), F.coalesce(kernel.target_chapter(label), F.lit(-1)).alias("chapter"), kernel.target_anchor(F.col("kind"), F.col("number")).alias("anchor"))
