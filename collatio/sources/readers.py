"""Sources: extractors' trees, tool output, Markdown and built pages, asset files, tables with fixed schemas.

PDF pages, OCR models and image writers need programs that aren't part of this package. What they make is
read here as tables; `pdf_lines` is the seam where a page reader can be put in.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOX = "struct<x0: double, y0: double, x1: double, y1: double>"
SCHEMAS = {
    "lines": "book_id string, chapter int, page int, line_no int, text string, size double, x0 double, y0 double, x1 double, y1 double, fonts array<string>, small_caps array<string>, page_height double",
    "regions": "book_id string, chapter int, page int, region_no int, x0 double, y0 double, x1 double, y1 double, kind string, source string, text string, key string",
    "blocks": "book_id string, chapter int, block_no int, id string, type string, page int, text string, source string, agreement double, flags array<string>, label string, label_kind string, level int, anchor string, asset string, caption string, alt string, latex string, cells array<array<string>>, x0 double, y0 double, x1 double, y1 double, interior_text array<string>, small_caps array<string>",
    "chapters": "book_id string, number int, title string, printed_page int, pdf_page int, pdf_page_end int, part int",
    "assets": f"book_id string, chapter int, label string, label_kind string, block string, file string, webp string, width int, height int, page int, printed_page int, bbox {BOX}, alt string, caption string, sha256 string, source string, issue string",
    "verdicts": "chapter int, page int, verdict string, checked array<string>, note string, reviewer string, recorded_at timestamp",
}


def read_json(spark: SparkSession, path: str, table: str) -> DataFrame:
    """JSON documents of one of SCHEMAS; sparse files keep all columns because nothing is inferred."""
    return spark.read.schema(SCHEMAS[table]).option("multiLine", True).json(path)


def read_pages(spark: SparkSession, root: str, pattern: str = "*.md", name: str = "markdown") -> DataFrame:
    """path under `root` and content of all files of a kind."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    base = root.rstrip("/").split("://", 1)[-1].split(":", 1)[-1]
    return files.select(F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "^[a-z]+:/*", "/"), f"^.*?{base.rstrip('/')}/", "").alias("path"), F.col("value").alias(name))


def read_assets(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, length, content and digest of files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", "content", F.sha2("content", 256).alias("sha256"))


def info_fields(text: DataFrame) -> DataFrame:
    """key and value of "Key: value" lines; keys in lower case with underscores."""
    lines = text.select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").contains(":"))
    return lines.select(F.replace(F.lower(F.trim(F.substring_index("line", ":", 1))), F.lit(" "), F.lit("_")).alias("key"), F.trim(F.regexp_extract("line", "^[^:]*:(.*)$", 1)).alias("value"))


def font_table(text: DataFrame) -> DataFrame:
    """name, embedded and mapped of a font listing, whose columns are counted from the right."""
    rows = text.select(F.posexplode(F.split("text", "\n")).alias("n", "line")).where("n >= 2 and trim(line) <> ''")
    cols = F.split(F.trim("line"), r"\s+")
    return rows.select(F.element_at(cols, 1).alias("name"), (F.element_at(cols, -5) == "yes").alias("embedded"), (F.element_at(cols, -3) == "yes").alias("mapped"))


def images_per_page(text: DataFrame) -> DataFrame:
    """page and number of images of an image listing."""
    rows = text.select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(r"^\s*\d+\s+\d+"))
    return rows.groupBy(F.regexp_extract("line", r"^\s*(\d+)", 1).cast("int").alias("page")).agg(F.count("*").alias("n"))


def provenance_regions(documents: DataFrame) -> DataFrame:
    """Regions of documents (book_id, chapter, json) that list texts, pictures and tables with their places.

    A piece with several places gives a row for each; boxes measured from the page's foot are turned over.
    """
    box = "struct<l: double, t: double, r: double, b: double, coord_origin: string>"
    item = f"array<struct<label: string, text: string, self_ref: string, prov: array<struct<page_no: int, bbox: {box}>>>>"
    schema = f"struct<pages: map<string, struct<size: struct<height: double>>>, texts: {item}, pictures: {item}, tables: {item}>"
    d = documents.select("book_id", "chapter", F.from_json("json", schema).alias("d"))
    none = F.array().cast(item)
    every = F.concat(*(F.coalesce(f"d.{c}", none) for c in ("texts", "pictures", "tables")))
    rows = d.select("book_id", "chapter", F.col("d.pages").alias("pages"), F.posexplode(every).alias("n", "i")).select("book_id", "chapter", "pages", "n", "i", F.posexplode("i.prov").alias("m", "p"))
    h = F.coalesce(F.try_element_at(F.col("pages"), F.col("p.page_no").cast("string"))["size"]["height"], F.lit(792.0))
    foot = F.col("p.bbox.coord_origin") == "BOTTOMLEFT"
    y = lambda c: F.when(foot, h - F.col(f"p.bbox.{c}")).otherwise(F.col(f"p.bbox.{c}"))
    found = rows.select(
        "book_id", "chapter", F.col("p.page_no").alias("page"), (F.col("n") * 1000 + F.col("m")).cast("int").alias("region_no"), F.col("p.bbox.l").alias("x0"), F.least(y("t"), y("b")).alias("y0"), F.col("p.bbox.r").alias("x1"), F.greatest(y("t"), y("b")).alias("y1"),
        F.col("i.label").alias("kind"), F.lit("docling").alias("source"), F.coalesce("i.text", F.lit("")).alias("text"), F.coalesce("i.self_ref", F.lit("")).alias("key"),
    )
    return found.where("page > 0 and x0 is not null")


def tree_regions(documents: DataFrame) -> DataFrame:
    """Regions of documents (book_id, chapter, json) that are trees of blocks; a block without a page has its parent's."""

    def walk(node: dict[str, Any], page: int | None, out: list[dict]) -> None:
        stack = [(node, page)]
        while stack:
            n, p = stack.pop()
            parts = str(n.get("id") or "").split("/")
            if "page" in parts[:-1] and parts[parts.index("page") + 1].isdigit():
                p = int(parts[parts.index("page") + 1]) + 1
            kind, box = n.get("block_type") or "", n.get("bbox")
            if box and p and kind not in ("Page", "Document"):
                out.append({"page": p, "x0": float(box[0]), "y0": float(box[1]), "x1": float(box[2]), "y1": float(box[3]), "kind": kind, "html": n.get("html") or "", "key": str(n.get("id") or "")})
            stack += [(c, p) for c in reversed(n.get("children") or [])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows: list[dict] = []
            for r in f.itertuples(index=False):
                out: list[dict] = []
                walk(json.loads(r.json), None, out)
                rows += [{"book_id": r.book_id, "chapter": r.chapter, "region_no": k} | x for k, x in enumerate(out)]
            yield pd.DataFrame(rows, columns=["book_id", "chapter", "page", "region_no", "x0", "y0", "x1", "y1", "kind", "html", "key"])

    from collatio.functions.kernel import html_text

    flat = documents.select("book_id", "chapter", "json").mapInPandas(run, "book_id string, chapter int, page int, region_no int, x0 double, y0 double, x1 double, y1 double, kind string, html string, key string")
    return flat.withColumn("source", F.lit("marker")).withColumn("text", html_text(F.col("html"))).drop("html")


def comparable(regions: DataFrame, excluded_kinds: tuple[str, ...], excluded: DataFrame) -> DataFrame:
    """Regions (id) whose text can be compared: of other kinds, not inside what is excluded, and no groups, each key once."""
    from collatio.operators.aggregates import first_of_key
    from collatio.operators.geometry import outside

    keys = ["book_id", "chapter", "page"]
    kept = outside(regions.where(~F.col("kind").isin(*excluded_kinds) & ~F.col("kind").endswith("Group")), excluded, keys, 0.6)
    return first_of_key(kept, "key", ["region_no"], ["book_id", "chapter", "source"])


def pdf_lines(files: DataFrame, reader: Callable[[bytes], Iterator[dict[str, Any]]]) -> DataFrame:
    """Lines of PDF files (path, content) by a page reader that yields rows of SCHEMAS["lines"] without book_id."""
    names = [c.split()[0] for c in SCHEMAS["lines"].split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"], strict=True):
                yield pd.DataFrame([{"book_id": path} | row for row in reader(content)], columns=names)

    return files.select("path", "content").mapInPandas(run, SCHEMAS["lines"])


def chapter_pages(pages: DataFrame, chapters: DataFrame) -> DataFrame:
    """Pages (book_id, page) with their chapter, by its first and last page."""
    from collatio.operators.geometry import intervals

    starts = chapters.select("book_id", F.col("pdf_page").alias("start"), F.col("number").alias("chapter"), F.col("pdf_page_end").alias("last"))
    found = intervals(pages, starts, "page", "start", ["book_id"]).where("interval_chapter is not null and page <= interval_last")
    return found.withColumnRenamed("interval_chapter", "chapter").drop("interval_start", "interval_last")
