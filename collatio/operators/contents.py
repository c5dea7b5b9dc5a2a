"""A book's boundaries: its table of contents as parts, chapters and sections, and the pages they begin on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collatio.functions import kernel
from collatio.operators.layout import by_page

# Fixed values.
PREFACE = r"^\s*(Preface)\s{2,}([ivxl]+)\s*$"
PART = r"^\s*(I|II|III|IV|V|VI|VII)\s\s+(\S.*?)\s{2,}(\d+)\s*$"
SECTION = r"^\s*(\d{1,2}\.\d{1,2}(?:\.\d{1,2})?)\s*(\S.*?)[.\s]{3,}(\d+)\s*$"
CHAPTER = r"^\s*(?:Chapter\s+)?(\d{1,2})\s*:?\s+([A-Z]\S*.*?)\s{2,}(\d+)\s*$"
ENTRY_START = r"^\s*(?:\d{1,2}\.\d{1,2}(?:\.\d{1,2})?\s+\S|(?:Chapter\s+)?\d{1,2}\s*:?\s+[A-Z])"
ENDS_IN_PAGE = r"(?i)(?:^|\s)(?:\d+|[ivxlcdm]+)\s*$"
ORDINAL = r"(?i)^\s*(?:chapter\s+)?(?:\d{1,3}|[ivxlcdm]{1,6})\s*[:.\-–—]?\s+"
BACK_MATTER = ("Bibliography", "References", "Index", "Appendix")
NUMERALS = ("I", "II", "III", "IV", "V", "VI", "VII")
MATCH, HEADING_SIZE, FRONT_SIZE, MOST_PAGES = 90.0, 14.0, 16.0, 50


def contents_pages(pages: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """Pages (page, text) of the contents: from the first that says CONTENTS near its top, as long as they go on saying it."""
    w = Window.partitionBy(*keys).orderBy("page")
    says = F.upper(F.substring("text", 1, 200)).contains("CONTENTS")
    seen = F.sum(F.when(says, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = pages.withColumn("__says", says).withColumn("__seen", seen).where("__seen > 0")
    stops = F.sum(F.when(F.col("__says"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("__stops", stops).withColumn("__n", F.row_number().over(w)).where(f"__stops = 0 and __n <= {MOST_PAGES}").drop("__says", "__seen", "__stops", "__n")


def joined_entries(lines: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """Lines (line_no, text) with entries that wrap put together: an entry's start takes all lines up to one that ends in a page."""

    def run(pdf) -> list[dict]:
        out: list[dict] = []
        waiting = False
        for r in pdf.sort_values("line_no").itertuples(index=False):
            if waiting:
                out[-1]["text"] = f"{out[-1]['text'].rstrip()} {r.text.strip()}"
            else:
                out.append({"line_no": int(r.line_no), "text": r.text})
            waiting = not r.ends and (waiting or bool(r.starts))
        return out

    clean = kernel.clean_contents_line(F.col("text"))
    facts = lines.select(*keys, "line_no", clean.alias("text")).where("text <> ''").withColumn("starts", F.col("text").rlike(ENTRY_START)).withColumn("ends", F.col("text").rlike(ENDS_IN_PAGE))
    return by_page(facts, list(keys), run, "line_no int, text string")


def entries(lines: DataFrame) -> DataFrame:
    """kind, number, title and printed page of lines, the first of preface, part, section and chapter that fits."""
    t = F.col("text")
    kind = F.when(t.rlike(PREFACE), "preface").when(t.rlike(PART), "part").when(t.rlike(SECTION), "section").when(t.rlike(CHAPTER), "chapter")
    pick = lambda i: F.when(F.col("kind") == "preface", F.regexp_extract(t, PREFACE, i)).when(F.col("kind") == "part", F.regexp_extract(t, PART, i)).when(F.col("kind") == "section", F.regexp_extract(t, SECTION, i)).otherwise(F.regexp_extract(t, CHAPTER, i))
    e = lines.withColumn("kind", kind).where("kind is not null")
    preface = F.col("kind") == "preface"
    return e.select(
        *(c for c in lines.columns if c != "text"), "kind", F.when(preface, "0").otherwise(pick(1)).alias("number"), kernel.collapsed(F.when(preface, pick(1)).otherwise(pick(2))).alias("title"), F.when(preface, pick(2)).otherwise(F.when(~preface, pick(3))).alias("printed_page"),
    )


def roman_number(numeral: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, NUMERALS)), numeral).cast("int")


def section_chapters(sections: DataFrame, chapters: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """Sections with the chapter that their number begins with."""
    s = sections.withColumn("chapter", F.split("number", r"\.")[0].cast("int"))
    return s.join(chapters.select(*keys, F.col("number").cast("int").alias("chapter")).distinct(), [*keys, "chapter"])


def part_of(chapters: DataFrame, parts: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """Chapters (pdf_page) with the part whose pages they are in."""
    from collatio.operators.geometry import intervals

    starts = parts.select(*keys, F.col("pdf_page").alias("start"), F.col("number").alias("part"))
    return intervals(chapters, starts, "pdf_page", "start", keys).withColumnRenamed("interval_part", "part").drop("interval_start")


def heading_page(lines: DataFrame, wanted: str, keys: Sequence[str] = ("book_id",), size: float = HEADING_SIZE) -> DataFrame:
    """keys and the first page with the wanted line large among its first four."""
    return lines.where((F.col("line_no") < 4) & (kernel.strip(F.col("text")) == wanted) & (F.col("size") > size)).groupBy(*keys).agg(F.min("page").alias("page"))


def heading_candidates(lines: DataFrame, threshold: Column, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """keys, page and what its first eight lines say in heading size."""
    large = lines.where((F.col("line_no") < 8) & (F.col("size") >= threshold))
    return large.groupBy(*keys, "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: kernel.strip(x["text"])), " ").alias("candidate"))


def title_score(candidate: Column, title: Column) -> Column:
    """How alike a heading and a title are, with the heading's leading ordinal or without it."""
    a, b, c = (kernel.exact_normal(x) for x in (candidate, title, F.regexp_replace(candidate, ORDINAL, "")))
    return F.greatest(kernel.indel_ratio(a, b), kernel.indel_ratio(c, b))


def chapter_starts(candidates: DataFrame, titles: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """number and pdf_page: each chapter's first page that its title stands on, a page starting one chapter at most.

    Pages with anything in heading size and titles are few for a book, and meet within it.
    """
    pairs = candidates.join(titles.select(*keys, F.col("number").cast("int").alias("number"), "title"), list(keys)).withColumn("score", title_score(F.col("candidate"), F.col("title"))).where(F.col("score") >= MATCH)

    def run(pdf) -> list[dict]:
        starts: dict[int, int] = {}
        taken: set[int] = set()
        for r in pdf.sort_values(["page", "number"]).itertuples(index=False):
            if r.number not in starts and r.page not in taken:
                starts[int(r.number)] = int(r.page)
                taken.add(r.page)
        return [{"number": n, "pdf_page": p} for n, p in starts.items()]

    return by_page(pairs.select(*keys, "page", "number"), list(keys), run, "number int, pdf_page int")


def checked(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """`df`, which fails when it is read if a row doesn't meet the condition."""
    return df.where(F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def boundary_map(lines: DataFrame, contents_lines: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """The preface and the chapters of a book with their title, first and last page and part, from its lines and those of its contents.

    The last chapter ends before the first heading of the back matter, or with the book. Fails when it is read if a
    book's contents have no chapter, a chapter of them begins nowhere, printed and PDF pages aren't a constant apart,
    or there is no preface.
    """
    from collatio.operators.aggregates import upper_median
    from collatio.operators.geometry import clipped_ends

    k = list(keys)
    found = entries(joined_entries(contents_lines, keys))
    chapters = found.where("kind = 'chapter'").select(*k, F.col("number").cast("int").alias("number"), "title", F.col("printed_page").cast("int").alias("printed_page"))
    # One row of facts for each book, also for one whose contents weren't found.
    large = F.col("size") > FRONT_SIZE
    says = lambda *names: large & (F.col("line_no") < 4) & kernel.strip(F.col("text")).isin(*names)
    books = lines.groupBy(*k).agg(F.min(F.when(says("Preface"), F.col("page"))).alias("__preface"), F.min(F.when(says(*BACK_MATTER), F.col("page"))).alias("__back"), F.max("page").alias("__last"))
    body = upper_median(lines, "size", keys)
    threshold = F.greatest(F.col("upper_median") * 1.5, F.col("upper_median") + 4)
    heads = heading_candidates(lines.join(body, k).withColumn("__t", threshold), F.col("__t"), keys)
    placed = books.join(chapters, k, "left").join(chapter_starts(heads, chapters, keys), [*k, "number"], "left")
    placed = checked(placed, F.col("number").isNotNull(), "no chapter in the contents")
    placed = checked(placed, F.col("pdf_page").isNotNull(), "a chapter of the contents begins on no page")
    placed = checked(placed, F.col("__preface").isNotNull(), "no preface")
    offset = placed.groupBy(*k).agg(F.count_distinct(F.col("pdf_page") - F.col("printed_page")).alias("__offsets"), F.first(F.col("pdf_page") - F.col("printed_page")).alias("__d"))
    placed = checked(placed.join(offset, k), F.col("__offsets") == 1, "printed and PDF pages are not a constant apart").drop("__offsets", "__d")
    parts = found.where("kind = 'part'").select(*k, F.col("printed_page").cast("int").alias("__p"), roman_number(F.col("number")).alias("number"))
    dividers = parts.join(offset, k).select(*k, "number", (F.col("__p") + F.col("__d")).alias("pdf_page"))
    body_end = F.coalesce(F.col("__back") - 1, F.col("__last"))
    ends = clipped_ends(placed, dividers, keys).withColumn("pdf_page_end", F.least(F.coalesce("pdf_page_end", body_end), body_end)).drop("next_page", "divider")
    whole = part_of(ends, dividers, keys).drop("__preface", "__back", "__last")
    first = placed.groupBy(*k, "__preface").agg(F.min("pdf_page").alias("__first"))
    preface = first.select(*k, F.lit(0).alias("number"), F.lit("Preface").alias("title"), F.lit(1).alias("printed_page"), F.col("__preface").alias("pdf_page"), (F.col("__first") - 1).alias("pdf_page_end"), F.lit(None).cast("int").alias("part"))
    return preface.unionByName(whole.select(*preface.columns))
