"""Equations in extractors' HTML, and counts of a chapter's labelled structures on both sides of a comparison."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collatio.functions import kernel

# Fixed values.
MATH = r"(?s)<math[^>]*>(.*?)</math>"
BARE_LABEL = r"^\(\s*\d+\.\d+\s*\)$"
RESIDUE = r"^[.,;:]?\s*\(\s*\d+\.\d+\s*\)\s*$"
QUAD_LABEL = r"\s*\\quad\s*\(\s*(\d+)\.(\d+)\s*\)\s*$"
END_LABEL = r"\(\s*(\d+)\.(\d+)\s*\)\s*$"
FIGURE, TABLE = r"^Figure\s+(\d+\.\d+)\s*[.:]", r"^Table\s+(\d+\.\d+)\s*[.:]"


@F.pandas_udf(T.StringType())
def unescaped(text: pd.Series) -> pd.Series:
    """HTML entities as characters."""
    return text.map(html.unescape, na_action="ignore")


def _label(text: Column, pattern: str) -> Column:
    found = F.concat_ws(".", F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2))
    return F.when(text.rlike(pattern), found)


def equations(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, latex, label and anchor of equation blocks (html): one formula with its label, or words that carry one.

    Tables of several formulas and formulas within prose are none, and neither is LaTeX that can't be whole.
    """
    h = F.coalesce("html", F.lit(""))
    # Entities go one by one, behind a mark that can't be in a formula, because a function of arrays can't call a UDF.
    parts = F.split(unescaped(F.array_join(F.regexp_extract_all(h, F.lit(MATH), F.lit(1)), "\u0001")), "\u0001")
    b = blocks.select(*keys, h.alias("h"), F.transform(parts, kernel.strip).alias("all"))
    content = F.filter("all", lambda m: (m != "") & ~m.rlike(BARE_LABEL))
    rest = kernel.html_text(F.regexp_replace("h", MATH, " "))
    b = b.withColumn("content", content).withColumn("plain", kernel.html_text(F.col("h"))).withColumn("rest", rest)
    n = F.size("content")
    b = b.where(~(F.col("h").contains("<table") & (n != 1)) & ~((n > 0) & (F.col("rest") != "") & ~F.col("rest").rlike(RESIDUE)))
    latex = F.array_join("content", " ")
    quad = _label(latex, QUAD_LABEL)
    label = F.coalesce(quad, _label(F.col("plain"), END_LABEL))
    body = F.when(quad.isNotNull(), F.rtrim(F.regexp_replace(latex, QUAD_LABEL, ""))).otherwise(latex)
    words = F.regexp_replace(kernel.strip(F.regexp_replace("plain", END_LABEL, "")), ",+$", "")
    formula = F.when(n > 0, F.when(~kernel.malformed_latex(latex), body)).when(label.isNotNull(), F.when(words == "", label).otherwise(F.concat(F.lit("\\text{"), words, F.lit("}"))))
    out = b.select(*keys, formula.alias("formula"), label.alias("label")).where("formula is not null")
    tag = F.when(F.col("label").isNotNull(), F.concat(F.lit(" \\tag{"), F.col("label"), F.lit("}"))).otherwise("")
    return out.select(*keys, F.concat("formula", tag).alias("latex"), "label", F.concat(F.lit("eq-"), F.replace("label", F.lit("."), F.lit("-"))).alias("anchor"))


def corrected(found: DataFrame, corrections: DataFrame, on: Sequence[str] = ("page", "latex")) -> DataFrame:
    """Equations with the replacement of those that a table of corrections (page, latex, replacement) names exactly."""
    c = corrections.select(*on, "replacement")
    return found.join(c, list(on), "left").withColumn("latex", F.coalesce("replacement", "latex")).drop("replacement")


def structures(rows: DataFrame, body: Column, keys: Sequence[str] = ("book_id", "chapter"), chapter: str | None = "chapter") -> DataFrame:
    """Labelled structures of rows (page, id, text, size, y0, page_height): label sets, exercises in sequence, footnotes.

    An equation's label begins with its chapter's number. Exercises count only behind their heading, each the next one.
    """
    from collatio.operators.reconcile import EXERCISE, FOOTNOTE, SECTION

    t, size = F.col("text"), F.col("size")
    pick = lambda p: F.nullif(F.regexp_extract(t, p, 1), F.lit(""))
    own = F.regexp_extract(t, END_LABEL, 1).try_cast("int").eqNullSafe(F.col(chapter)) if chapter else F.lit(True)
    large = size > body + 1.5
    note = (size >= body - 3.5) & (size < body - 1.0) & (F.col("y0") / F.col("page_height") > 0.70) & t.rlike(FOOTNOTE) & ~kernel.is_integer_soup(t) & ~kernel.is_letter_soup(t)
    marks = rows.select(
        *keys, F.struct("page", F.round("y0", 1).alias("y"), "id").alias("at"), pick(FIGURE).alias("figure"), pick(TABLE).alias("table"), F.when(large, pick(SECTION)).alias("section"),
        F.when(own & ~kernel.is_data_row(t), _label(t, END_LABEL)).alias("equation"), F.when(large & t.rlike(SECTION) & t.contains("Exercises"), 0).otherwise(pick(EXERCISE).cast("int")).alias("number"), note.alias("note"),
    )
    in_order = F.transform(F.array_sort(F.collect_list(F.when(F.col("number").isNotNull(), F.struct("at", "number")))), lambda x: x["number"])
    # -1 before the heading, which is 0; then the last number that was next.
    count = F.aggregate(in_order, F.lit(-1), lambda a, x: F.when(x == 0, F.greatest(a, F.lit(0))).when((a >= 0) & (x == a + 1), x).otherwise(a))
    labels = lambda c: F.array_sort(F.collect_set(c))
    return marks.groupBy(*keys).agg(labels("figure").alias("figures"), labels("table").alias("tables"), labels("section").alias("sections"), labels("equation").alias("equations"), F.greatest(count, F.lit(0)).alias("exercises"), F.count_if("note").cast("int").alias("footnotes"))


def model_counts(blocks: DataFrame, keys: Sequence[str] = ("book_id", "chapter")) -> DataFrame:
    """The same of blocks (type, label, label_kind); the caption's word, not the form, says what is a table."""
    exhibit, is_table = F.col("type").isin("figure", "matrix"), F.coalesce(F.col("label_kind") == "table", F.lit(False))
    labels = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("label"))))
    n = lambda t: F.count_if(F.col("type") == t).cast("int").alias(f"{t}s" if t != "matrix" else "matrices")
    return blocks.groupBy(*keys).agg(
        labels(exhibit & ~is_table).alias("figures"), labels((exhibit | (F.col("type") == "table")) & is_table).alias("tables"), labels(F.col("type") == "heading").alias("sections"), labels(F.col("type") == "equation").alias("equations"), n("exercise"), n("footnote"), n("matrix"),
    )


def with_assets(blocks: DataFrame, assets: DataFrame, keys: Sequence[str] = ("book_id", "chapter")) -> DataFrame:
    """Blocks (id) with the file of their asset; of several the last (n)."""
    last = assets.where("issue is null").groupBy(*keys, F.col("block").alias("id")).agg(F.max_by("file", "n").alias("asset"))
    return blocks.drop("asset").join(last, [*keys, "id"], "left")


def by_reason(removed: DataFrame, keys: Sequence[str], reason: str = "reason") -> DataFrame:
    """How many rows each reason took, or how many references it left."""
    return removed.groupBy(*keys, reason).agg(F.count("*").alias("n"))


def flagged_pages(blocks: DataFrame, keys: Sequence[str] = ("book_id", "chapter")) -> DataFrame:
    return blocks.where(F.size("flags") > 0).select(*keys, "page").distinct()
