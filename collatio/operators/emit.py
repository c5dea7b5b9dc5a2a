"""Emission: where documents stand, what references point to, blocks as Markdown, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collatio.functions import kernel, markdown

# Fixed values.
LINKED = r"(?U)\b(?:(?:Chapter|Exercise)\s+\d+\b|(?:Section|Figure|Table)\s+\d+\.\d+\b|Equation\s+\(?\d+\.\d+\)?)"
BIB_ENTRY = r"(?s)^\[(\d{1,3})\]\s*(.*)$"


def document_path(part_slug: Column, number: Column, title: Column) -> Column:
    """part/NN-title, or NN-title outside parts."""
    name = F.concat(F.lpad(number.cast("string"), 2, "0"), F.lit("-"), kernel.slug(title))
    return F.when(part_slug.isNull(), name).otherwise(F.concat(part_slug, F.lit("/"), name))


def registry(chapters: DataFrame, sections: DataFrame, assets: DataFrame, equations: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """keys, kind, label, path and anchor of everything a reference can point to; of equal labels the later source counts."""
    k = list(keys)
    row = lambda df, kind, label, anchor, rank: df.select(*k, F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"), label.alias("label"), "path", anchor.alias("anchor"), F.lit(rank).alias("rank"))
    dashed = lambda p: F.concat(F.lit(p), F.replace(F.col("label"), F.lit("."), F.lit("-")))
    paths = chapters.select(*k, F.col("number").alias("chapter"), "path")
    in_chapter = lambda df: df.join(paths, [*k, "chapter"])
    all_rows = row(chapters, "Chapter", F.col("number").cast("string"), F.concat(F.lit("chapter-"), F.col("number").cast("string")), 0)
    all_rows = all_rows.unionByName(row(in_chapter(sections), "Section", F.col("label"), dashed("sec-"), 1))
    fine = in_chapter(assets.where("issue is null and label is not null"))
    all_rows = all_rows.unionByName(row(fine, F.initcap("label_kind"), F.col("label"), F.when(F.col("label_kind") == "table", dashed("tbl-")).otherwise(dashed("fig-")), 2))
    all_rows = all_rows.unionByName(row(in_chapter(equations.where("label is not null")), "Equation", F.col("label"), dashed("eq-"), 3))
    w = Window.partitionBy(*k, "kind", "label").orderBy(F.desc("rank"), "path")
    return all_rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "rank")


def linked(texts: DataFrame, places: DataFrame, bibliography: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Texts (id, text) of `keys` with references and citations as links, and the references that stay unresolved.

    A text is cut at its references; the pieces are joined with what they point to and put together again.
    Citations are linked only if all their numbers are known entries.
    """
    k = list(keys)
    safe = F.replace(F.replace("text", F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    pattern = f"(?:{LINKED})|(?:{kernel.CITATION})"
    gaps, found = F.split(safe, pattern, -1), F.regexp_extract_all(safe, F.lit(pattern), F.lit(0))
    pieces = F.arrays_zip(gaps.alias("gap"), found.alias("ref"))
    rows = texts.select(*k, "id", F.posexplode(pieces).alias("at", "p")).select(*k, "id", "at", "p.gap", "p.ref")
    kind, number = F.regexp_extract("ref", r"^(\p{L}+)", 1), F.regexp_extract("ref", r"(\d+(?:\.\d+)?)", 1)
    rows = rows.withColumn("kind", kind).withColumn("number", number)
    p = places.select(*[F.col(c).alias(f"__{c}") for c in k if c in places.columns], F.col("kind").alias("__kind"), F.col("label").alias("__label"), "path", "anchor")
    on = (F.col("kind") == F.col("__kind")) & (F.col("number") == F.col("__label"))
    for c in k:
        if c in places.columns:
            on = on & (F.col(c) == F.col(f"__{c}"))
    to = rows.join(p, on, "left")
    # A book's entries have three digits at most; they are few, and meet the texts of their own book alone.
    own = [c for c in k if c in bibliography.columns]
    known = bibliography.groupBy(*own).agg(F.collect_set("number").alias("__known"))
    to = to.join(known, own, "left") if own else to.join(known)
    to = to.withColumn("__known", F.coalesce("__known", F.array().cast(known.schema["__known"].dataType)))
    is_citation = F.col("ref").startswith("[")
    cites = kernel.citations(F.col("ref"))
    entry = F.concat(F.lit("["), F.array_join(F.transform(cites, lambda n: F.concat(F.lit("["), n.cast("string"), F.lit("](/bibliography#ref-"), n.cast("string"), F.lit(")"))), ", "), F.lit("]"))
    link = F.concat(F.lit("["), F.col("ref"), F.lit("](/"), F.col("path"), F.when(F.col("kind") == "Chapter", "").otherwise(F.concat(F.lit("#"), F.col("anchor"))), F.lit(")"))
    all_known = F.size(F.array_except(cites, F.col("__known"))) == 0
    new = F.when(F.col("ref").isNull(), "").when(is_citation & all_known, entry).when(~is_citation & F.col("path").isNotNull(), link).otherwise(F.col("ref"))
    done = to.withColumn("new", F.concat(F.coalesce("gap", F.lit("")), new))
    text = done.groupBy(*k, "id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "new"))), lambda x: x["new"]), "").alias("text"))
    reason = F.when(is_citation & (F.size("__known") == 0), "no_bibliography").when(~is_citation & F.col("path").isNull(), "target_not_emitted")
    unresolved = done.where("ref is not null").select(*k, "id", "at", F.col("ref").alias("label"), reason.alias("reason")).where("reason is not null")
    return text, unresolved


def block_markdown(blocks: DataFrame) -> DataFrame:
    """Blocks (type, text, level, label, label_kind, anchor, caption, alt, asset, cells, latex) with their `lines` of Markdown.

    Level-1 headings and captions that an exhibit carries give none.
    """
    anchor = F.when(F.col("anchor").isNotNull(), F.concat(F.lit(" {#"), F.col("anchor"), F.lit("}"))).otherwise("")
    mark = F.when(F.col("anchor").isNotNull(), F.concat(F.lit('<a id="'), F.col("anchor"), F.lit('"></a>'))).otherwise("")
    named = F.when(F.col("label").isNotNull(), F.concat(F.lit("**"), F.initcap(F.coalesce("label_kind", F.lit("figure"))), F.lit(" "), F.col("label"), F.lit(":** "), F.coalesce("caption", F.lit("")))).otherwise("")
    picture = F.concat(F.lit("!["), F.coalesce("alt", F.lit("")), F.lit("](/"), F.col("asset"), F.lit(")"))
    t = F.col("type")
    lines = (
        F.when((t == "heading") & (F.col("level") == 1), F.array())
        .when(t == "heading", F.array(F.concat(F.repeat(F.lit("#"), F.coalesce("level", F.lit(2))), F.lit(" "), F.col("text"), anchor)))
        .when((t == "caption") & F.col("label").isNotNull(), F.array())
        .when(t == "caption", F.array(F.concat(F.lit("*"), F.col("text"), F.lit("*"))))
        .when(t == "figure", F.filter(F.array(mark, F.coalesce(picture, F.lit("")), named), lambda x: x != ""))
        .when(t == "matrix", F.filter(F.array(mark, markdown.table(F.col("cells")), named), lambda x: x != ""))
        .when(t == "equation", F.filter(F.array(mark, F.concat(F.lit("$$\n"), F.col("latex"), F.lit("\n$$"))), lambda x: x != ""))
        .when(t == "footnote", F.array(F.concat(F.lit("> "), F.col("text"))))
        .otherwise(F.array("text"))
    )
    return blocks.withColumn("lines", lines)


def pages(blocks: DataFrame, titles: DataFrame, keys: Sequence[str] = ("book_id", "chapter")) -> DataFrame:
    """keys and Markdown of chapters: front matter and title, then the blocks (place, lines) in order."""
    body = blocks.groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "lines"))), lambda b: b["lines"])).alias("lines"))
    full = titles.join(body, list(keys), "left")
    head = F.concat(F.lit("---\nid: "), kernel.slug(F.col("title")), F.lit("\n---\n\n# "), kernel.display_title(F.col("chapter"), F.col("title")), F.lit("\n\n"))
    return full.select(*keys, F.concat(head, F.array_join(F.coalesce("lines", F.array().cast("array<string>")), "\n\n"), F.lit("\n")).alias("markdown"))


def bibliography(lines: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """number and text of entries: [n] opens one, other lines go on with it; of equal numbers the later entry counts."""
    w = Window.partitionBy(*keys).orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, 0)
    n = F.nullif(F.regexp_extract("text", BIB_ENTRY, 1), F.lit("")).cast("int")
    opened = lines.withColumn("n", n).withColumn("entry", F.count("n").over(w)).withColumn("number", F.last("n", ignorenulls=True).over(w)).where("number is not null")
    part = F.when(F.col("n").isNotNull(), F.regexp_extract("text", BIB_ENTRY, 2)).otherwise(F.col("text"))
    texts = opened.groupBy(*keys, "number", "entry").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "line_no", part.alias("t")))), lambda x: kernel.strip(x["t"])), " ").alias("text"))
    return texts.groupBy(*keys, "number").agg(F.max_by("text", "entry").alias("text"))


def sidebar(chapters: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """keys, part (null first) and the entries of its chapters in order."""
    return chapters.groupBy(*keys, "part").agg(F.array_sort(F.collect_list(F.struct("number", "title", "path"))).alias("items")).withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("part").asc_nulls_first())))


def site_index(documents: DataFrame) -> DataFrame:
    """(route, anchor) of pages (path, markdown); each route also with a null anchor."""
    routes = documents.select(markdown.route(F.col("path"), F.col("markdown")).alias("route"), markdown.anchors(F.col("markdown")).alias("a"))
    return routes.select("route", F.explode(F.concat(F.array(F.lit(None).cast("string")), "a")).alias("anchor")).distinct()


def site_links(documents: DataFrame, keys: Sequence[str] = ("path",)) -> DataFrame:
    return documents.select(*keys, F.explode(markdown.links(F.col("markdown"))).alias("l")).select(*keys, "l.*")


def inventory(index: DataFrame) -> DataFrame:
    """How many routes and anchors an index has."""
    return index.agg(F.count_distinct("route").alias("routes"), F.count("anchor").alias("anchors"))


def rendered_assets(assets: DataFrame, documents: DataFrame, built: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """keys and files that the chapter's Markdown, or its built page (html) where there is one, doesn't show.

    A built page shows a file by its name or by the first 64 characters of its Base64 form.
    """
    rows = assets.join(documents, list(keys))
    hidden = ~F.col("markdown").contains(F.concat(F.lit("](/"), F.col("file"), F.lit(")")))
    found = rows.where(hidden).select(*keys, "file", F.lit("not_in_markdown").alias("issue"))
    if built is not None:
        name = F.element_at(F.split("file", "/"), -1)
        shown = F.col("html").contains(name) | F.coalesce(F.col("html").contains(F.substring(F.base64("content"), 1, 64)), F.lit(False))
        found = found.unionByName(assets.join(built, list(keys)).where(~shown).select(*keys, "file", F.lit("not_in_html").alias("issue")))
    return found


def queue_markdown(queue: DataFrame, keys: Sequence[str], width: int = 180) -> DataFrame:
    """The review queue as one Markdown row each."""
    cut = F.substring(F.replace("what", F.lit("|"), F.lit("\\|")), 1, width)
    return queue.select(*keys, F.concat(F.lit("| "), F.concat_ws(" | ", *(F.col(c).cast("string") for c in keys), "kind", cut), F.lit(" |")).alias("row"))


def progress_table(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many chapters and pages (n_pages) are green."""
    green = F.col("status") == "green"
    return states.groupBy(*keys).agg(F.count_if(green).alias("chapters_green"), F.count("*").alias("chapters_total"), F.sum(F.when(green, F.col("n_pages")).otherwise(0)).alias("pages_green"), F.sum("n_pages").alias("pages_total"))


def home_page(items: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """keys and Markdown of a book's contents from `sidebar` rows: chapters outside parts first, then part by part."""
    lines = F.transform("items", lambda i: F.concat(F.lit("- ["), kernel.display_title(i["number"], i["title"]), F.lit("](/"), i["path"], F.lit(")")))
    head = F.when(F.col("part").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("## Part "), F.col("part").cast("string"))))
    rows = items.select(*keys, "place", F.concat(head, lines).alias("lines"))
    return rows.groupBy(*keys).agg(F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "lines"))), lambda r: r["lines"])), "\n").alias("markdown"))


def starter_readme(summary: DataFrame, title: str) -> DataFrame:
    """A first README of a book from `progress_table` rows."""
    line = F.format_string("%d of %d chapters and %d of %d pages pass every check.", "chapters_green", "chapters_total", "pages_green", "pages_total")
    return summary.select(F.concat(F.lit(f"# {title}\n\n"), line, F.lit("\n")).alias("markdown"))
