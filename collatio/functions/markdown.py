"""Column functions for Markdown: plain text of a page, tables, links, front matter and routes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is undone, in this order (pattern, replacement). (?d) makes only \n end a line.
FIGURE_DATA = (r'(?s)<span class="figure-data">.*?</span>', " ")
BEFORE = (
    (r"(?s)\A---\n.*?\n---\n", ""),
    (r"(?md)^[ \t]{0,3}#(?!#)[ \t]+.*\n?", ""),
    (r"(?s)<!--.*?-->", " "),
    (r"""(?md)^[ \t]*import\s[^\n]*?\sfrom\s['"][^'"\n]+['"];?[ \t]*$|^[ \t]*export\s+(?:default\b|const\b|function\b|class\b|\{)[^\n]*$""", " "),
    (r"(?s)```.*?```", " "),
)
AFTER = (
    (r"!\[[^\]]*\]\([^)]*\)", " "),
    (r"\[([^\]]*)\]\([^)]*\)", "$1"),
    (r"(?s)\$\$(.+?)\$\$", " "),
    (r"\$([^$\n]*\\[^$\n]*)\$", " "),
    (r"</?[A-Za-z][^>]*>", " "),
    (r"(?md)^\s*\|?[\s:|-]+\|[\s:|-]*$", " "),
    (r"\|", " "),
    (r"(?md)[ \t]*\{#[A-Za-z0-9_.:-]+\}[ \t]*$", ""),
    (r"(?md)^\s{0,3}#{1,6}\s+", ""),
    (r"(?md)^\s{0,3}>\s?", ""),
    (r"(?md)^\s*[-*+]\s+", ""),
    (r"(?s)\*\*(.+?)\*\*", "$1"),
)
LINK = r"\]\((/[^)\s]*)\)"
HEADING_ANCHOR = r"(?md)^\s{0,3}#{1,6}\s+.*?\{#([A-Za-z0-9_.:-]+)\}\s*$"
HTML_ANCHOR = r"""<a\s+id=["']([^"']+)["']"""


def plain_text(markdown: Column, without_figure_data: bool = False) -> Column:
    """A page without what its rendering added; figure data goes too where numbers are compared."""
    for pattern, new in (*BEFORE, *((FIGURE_DATA,) if without_figure_data else ()), *AFTER):
        markdown = F.regexp_replace(markdown, pattern, new)
    return markdown


def front_matter(markdown: Column) -> Column:
    """The id and slug fields at a page's head, as a map."""
    head = F.regexp_extract(markdown, r"(?s)\A---\n(.*?)\n---\n", 1)
    value = lambda name: F.nullif(F.regexp_replace(F.regexp_extract(head, rf"(?md)^{name}:\s*(.+?)\s*$", 1), "^[\"']+|[\"']+$", ""), F.lit(""))
    return F.map_filter(F.create_map(F.lit("id"), value("id"), F.lit("slug"), value("slug")), lambda _, v: v.isNotNull())


def _slashless(route: Column) -> Column:
    out = F.regexp_replace(route, "/+$", "")
    return F.when(out == "", F.lit("/")).otherwise(out)


def route(path: Column, markdown: Column) -> Column:
    """Where a page at a path under the document root is served: at its slug, or its id or unnumbered name in its folder."""
    front = front_matter(markdown)
    slug, name = F.try_element_at(front, F.lit("slug")), F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    stem = F.coalesce(F.try_element_at(front, F.lit("id")), F.regexp_replace(name, r"^\d+-", ""))
    folder = F.regexp_extract(path, "^(.*)/[^/]*$", 1)
    here = F.when(folder.isin("", "."), stem).otherwise(F.concat(folder, F.lit("/"), stem))
    return F.when(slug.startswith("/"), _slashless(slug)).otherwise(F.concat(F.lit("/"), F.regexp_replace(here, "^/+|/+$", "")))


def anchors(markdown: Column) -> Column:
    """The distinct anchors that a page defines."""
    found = [F.regexp_extract_all(markdown, F.lit(p), F.lit(1)) for p in (HEADING_ANCHOR, HTML_ANCHOR)]
    return F.array_union(*found)


def links(markdown: Column) -> Column:
    """Links within the site, files aside, as (route, anchor)."""
    pages = F.filter(F.regexp_extract_all(markdown, F.lit(LINK), F.lit(1)), lambda t: ~F.element_at(F.split(t, "/"), -1).contains("."))
    return F.transform(pages, lambda t: F.struct(_slashless(F.split(t, "#")[0]).alias("route"), F.nullif(F.regexp_extract(t, "#(.*)$", 1), F.lit("")).alias("anchor")))


def table(cells: Column) -> Column:
    """A grid as a table: short rows filled up, the first row and column bold, pipes and backslashes escaped."""
    width = F.array_max(F.transform(cells, F.size))
    full = F.transform(cells, lambda row: F.concat(row, F.array_repeat(F.lit(""), width - F.size(row))))

    def cell(text: Column, bold: Column) -> Column:
        plain = F.trim(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")))
        return F.when(bold & (plain != ""), F.concat(F.lit("**"), plain, F.lit("**"))).otherwise(plain)

    lines = F.transform(full, lambda row, r: F.concat(F.lit("| "), F.array_join(F.transform(row, lambda x, c: cell(x, (r == 0) | (c == 0))), " | "), F.lit(" |")))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.when(F.size(cells) == 0, F.lit("")).otherwise(F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), rest, F.array(F.lit(""))), "\n"))


def table_cells(markdown: Column) -> Column:
    """The cells of a page's table rows, rules skipped."""
    rows = F.filter(F.split(markdown, "\n"), lambda x: F.trim(x).startswith("|") & ~F.trim(x).rlike(r"^[\s:|-]+$"))
    inner = F.transform(rows, lambda x: F.regexp_replace(F.trim(x), r"^\||\|$", ""))
    return F.transform(inner, lambda x: F.transform(F.split(x, r"(?<!\\)\|"), lambda c: F.trim(F.replace(c, F.lit("**"), F.lit("")))))
