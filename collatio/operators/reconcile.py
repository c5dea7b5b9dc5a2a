"""From rows of text and extractors' boxes to typed blocks, and how well the extractors agree.

Everything that a row says by itself, or with the boxes about it, is a native column (`row_facts`).
What depends on the rows before is decided by one fold over the rows of a chapter, which gives each row
a role and a block number and nothing else (`segmented`); the blocks are assembled natively from that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collatio.functions import kernel
from collatio.operators import geometry, multiset
from collatio.operators.layout import by_page

# Fixed values.
CAPTION = r"(?s)^(Figure|Table)\s+(\d+\.\d+)\s*[.:]\s*(.*)$"
SUBCAPTION = r"^\(([a-z])\)\s+(.*)$"
SECTION = r"^(\d+\.\d+)\s+(\S.*)$"
EXERCISE = r"^(\d{1,2})\.\s+\S"
FOOTNOTE = "^\\d{1,2}\\s+[A-Za-z\"'‘’“”]"
REFERENCE = r"(?U)\b(?:(Chapter|Section|Figure|Table|Exercise)\s+(\d+(?:\.\d+)?)\b|(Equation)\s+\(?(\d+\.\d+)\)?)"
AGREEMENT_FLOOR, OVERLAP_FLOOR, CONTENT_WORDS, CAPTION_SLACK, GAP = 0.95, 0.3, 40, 6.0, 0.8
SCORED = ("paragraph", "caption", "heading", "exercise", "exercise_part")


def row_facts(rows: DataFrame, furniture: Column, body: Column, boxes: dict[str, DataFrame], keys: Sequence[str] = ("book_id", "chapter", "page")) -> DataFrame:
    """Rows (id, text, size, box, page_height) with what the fold asks of each.

    `boxes` holds captions, texts, figures, matrices and equations with id and box; `furniture` is a column
    with the reason for which a row is furniture, if it is.
    """
    k = list(keys)
    is_caption = F.col("text").rlike(CAPTION)
    out = rows.withColumn("is_caption", is_caption).withColumn("furniture", F.when(~is_caption, furniture))
    met = geometry.overlapping(rows, boxes["captions"], k, 0.5).withColumn("__area", geometry.area(geometry.box("r_")))
    caption_boxes = met.groupBy(*k, "id").agg(F.array_sort(F.collect_set("r_id")).alias("caption_boxes"), F.min_by("r_id", F.struct("__area", "r_id")).alias("caption_box"))
    owner = geometry.owner(rows, boxes["texts"], k).select(*k, "id", F.col("r_id").alias("owner"))
    pages = boxes["texts"].select(*k).distinct().withColumn("has_boxes", F.lit(True))
    figure = geometry.best(geometry.overlapping(rows, boxes["figures"], k, 0.6), k, [F.col("r_id")]).select(*k, "id", F.col("r_id").alias("figure"))
    flag = lambda df, name: df.select(*k, "id").distinct().withColumn(name, F.lit(True))
    in_matrix = flag(geometry.enclosed(rows, boxes["matrices"], k), "in_matrix")
    lower = (F.col("y1") - F.col("y0")) < 0.6 * (F.col("r_y1") - F.col("r_y0"))
    fused = geometry.best(geometry.overlapping(rows, boxes["matrices"], k, 0.5).where(lower), k, [F.col("r_id")]).select(*k, "id", F.col("r_id").alias("fused"))
    in_equation = flag(geometry.enclosed(rows, boxes["equations"], k), "in_equation")
    for more in (caption_boxes, owner, figure, in_matrix, fused, in_equation):
        out = out.join(more, [*k, "id"], "left")
    out = out.join(pages, k, "left")
    size, top = F.col("size"), F.col("y0") / F.col("page_height")
    note_size = (size >= body - 3.5) & (size < body - 1.0)
    yes = lambda c: F.coalesce(c, F.lit(False))
    return out.withColumns({
        "is_sub": F.col("text").rlike(SUBCAPTION) & (size < body - 1.0), "is_part": F.col("text").rlike(SUBCAPTION) & (size >= body - 1.0),
        "in_matrix": yes("in_matrix"), "in_equation": yes("in_equation"), "has_boxes": yes("has_boxes"),
        "large": size > body + 1.5, "is_section": F.col("text").rlike(SECTION), "opens_exercises": F.col("text").contains("Exercises"),
        "note_start": note_size & (top > 0.70) & F.col("text").rlike(FOOTNOTE) & ~kernel.is_integer_soup(F.col("text")) & ~kernel.is_letter_soup(F.col("text")), "note_more": note_size & (top > 0.55),
        "is_opener": kernel.is_chapter_opener(size, body), "exercise": F.nullif(F.regexp_extract("text", EXERCISE, 1), F.lit("")).cast("int"),
    })


class _Fold:
    """The state between the rows of a chapter."""

    def __init__(self) -> None:
        self.roles: list[tuple[object, str, int | None]] = []
        self.open: list = []
        self.kind: str | None = None
        self.box = None
        self.listing = False  # within the exercises
        self.count = 0
        self.blocks: list[str] = []

    def close(self) -> None:
        if self.open:
            self.blocks.append(self.kind or ("exercise" if self.listing and pd.notna(self.open[0].exercise) else "paragraph"))
            self.roles += [(r, "text", len(self.blocks) - 1) for r in self.open]
        self.open, self.kind = [], None

    def begin(self, row, kind: str) -> None:
        self.close()
        self.open, self.kind = [row], kind

    def alone(self, row, role: str, kind: str | None = None) -> None:
        """A row that is no part of running text; with a kind it is a block of its own."""
        if kind:
            self.blocks.append(kind)
        self.roles.append((row, role, len(self.blocks) - 1 if kind else None))

    def parted(self, row) -> bool:
        """Whether a new block begins with this row, by the boxes of both rows or else by the gap between them."""
        last = self.open[-1]
        if row.has_boxes and pd.notna(last.owner) and pd.notna(row.owner):
            return last.owner != row.owner
        return row.y0 - last.y1 > GAP * (last.y1 - last.y0)

    def take(self, row) -> None:
        """The first of these that applies, in this order."""
        if pd.notna(row.furniture):
            return self.alone(row, row.furniture)
        caption = row.is_caption and not (self.open and self.kind is None and not self.parted(row))
        if caption:
            self.begin(row, "caption")
            self.box = row.caption_box
            return None
        if self.kind == "caption":
            boxes = row.caption_boxes if row.caption_boxes is not None else []
            if pd.notna(self.box) and self.box in boxes:
                return self.open.append(row)
            self.close()
            self.box = None
        if row.in_matrix:
            self.close()
            return self.alone(row, "matrix_interior")
        if pd.notna(row.fused):
            self.close()
            return self.alone(row, "matrix_label", "paragraph")
        if row.in_equation:
            self.close()
            return self.alone(row, "equation_interior")
        if pd.notna(row.figure) and not row.is_sub:
            return self.alone(row, "figure_interior")
        if row.is_sub:
            self.begin(row, "caption")
            self.box = row.caption_box
            return None
        if row.large and row.is_section:
            self.begin(row, "heading")
            self.listing |= bool(row.opens_exercises)
            return None
        if self.kind == "heading":
            if row.large:
                return self.open.append(row)
            self.close()
        if row.note_start:
            return self.begin(row, "footnote")
        if self.kind == "footnote":
            if row.note_more:
                return self.open.append(row)
            self.close()
        if row.is_opener:
            self.close()
            return self.alone(row, "opener", "heading")
        if self.listing:
            if pd.notna(row.exercise) and int(row.exercise) == self.count + 1:
                self.close()
                self.count += 1
            elif row.is_part:
                self.close()
                self.kind = "exercise_part"
        if self.open and self.parted(row):
            self.close()
        return self.open.append(row)


FACTS = ("id", "page", "text", "x0", "y0", "x1", "y1", "is_caption", "furniture", "caption_box", "caption_boxes", "owner", "has_boxes", "figure", "in_matrix", "fused", "in_equation", "is_sub", "is_part", "large", "is_section", "opens_exercises", "note_start", "note_more", "is_opener", "exercise")


def segmented(facts: DataFrame, keys: Sequence[str] = ("book_id", "chapter")) -> DataFrame:
    """keys, page, id, role, block_no and kind of each row: the fold over a chapter's rows in reading order."""

    def run(pdf: pd.DataFrame) -> list[dict]:
        fold = _Fold()
        y = pd.Series([round(v, 1) for v in pdf["y0"]], index=pdf.index)
        ordered = pdf.assign(__y=y).sort_values(["page", "__y", "x0", "id"], kind="stable").drop(columns="__y")
        for _, page in ordered.groupby("page", sort=True):
            for row in page.itertuples(index=False):
                fold.take(row)
            fold.close()
            fold.box = None
        return [{"page": r.page, "id": r.id, "role": role, "block_no": no, "kind": fold.blocks[no] if no is not None else None} for r, role, no in fold.roles]

    return by_page(facts.select(*keys, *FACTS), list(keys), run, "page int, id long, role string, block_no int, kind string")


def blocks(rows: DataFrame, roles: DataFrame, known: DataFrame, keys: Sequence[str] = ("book_id", "chapter")) -> DataFrame:
    """Blocks of segmented rows: joined text, type, label, level, anchor, caption and box.

    `known` has each chapter's hyphenated forms.
    """
    k = list(keys)
    lines = rows.join(roles.where("block_no is not null"), [*k, "page", "id"])
    in_order = F.array_sort(F.collect_list(F.struct(F.round("y0", 1).alias("y"), "x0", "id", "text")))
    g = lines.groupBy(*k, "page", "block_no", "kind", "role").agg(
        F.transform(in_order, lambda r: r["text"]).alias("lines"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("small_caps")))).alias("small_caps"),
    )
    g = g.join(known, k, "left").withColumn("text", kernel.strip(kernel.output_form(kernel.joined_lines(F.col("lines"), F.coalesce("known_hyphens", F.array().cast("array<string>")))))).where("text <> ''")
    part = lambda p, i: F.nullif(F.regexp_extract("text", p, i), F.lit(""))
    caption, heading = F.col("kind") == "caption", (F.col("kind") == "heading") & (F.col("role") != "opener")
    label = F.when(caption, part(CAPTION, 2)).when(heading, part(SECTION, 1))
    return g.select(
        *k, "page", "block_no", F.col("kind").alias("type"), "text", "x0", "y0", "x1", "y1", "small_caps", label.alias("label"), F.when(caption, F.lower(part(CAPTION, 1))).alias("label_kind"),
        F.when(F.col("role") == "opener", 1).when(heading, 2).alias("level"), F.when(heading & label.isNotNull(), F.concat(F.lit("sec-"), F.replace(label, F.lit("."), F.lit("-")))).alias("anchor"),
        F.when(caption & label.isNotNull(), kernel.strip(F.regexp_extract("text", CAPTION, 3))).alias("caption"), F.lit("textlayer").alias("source"),
    )


BOUND = "block_no int, label string, label_kind string, caption string, x0 double, y0 double, x1 double, y1 double, caption_block int"


def bound_captions(found: DataFrame, keys: Sequence[str] = ("book_id", "chapter", "page")) -> DataFrame:
    """For each exhibit (figure or matrix) of a page the caption that it gets, and its box without it.

    Captions choose in order, exhibits without a caption first: a figure's the nearest one above, a table's the
    nearest below, else the first there is. `caption_block` null: nothing describes the exhibit.
    """

    def run(pdf: pd.DataFrame) -> list[dict]:
        ordered = pdf.sort_values(["y0", "x0", "block_no"], kind="stable")
        exhibits = [r._asdict() | {"label": None, "label_kind": None, "caption": None, "caption_block": None} for r in ordered[ordered["type"].isin(["figure", "matrix"])].itertuples(index=False)]
        for c in ordered[(ordered["type"] == "caption") & ordered["label"].notna()].itertuples(index=False):
            pool = [e for e in exhibits if e["caption_block"] is None] or exhibits
            table = c.label_kind == "table"
            side = [e for e in pool if (e["y1"] >= c.y1 - CAPTION_SLACK if table else e["y0"] <= c.y0 + CAPTION_SLACK)]
            pick = min(side, key=lambda e: max(0.0, e["y0"] - c.y1 if table else c.y0 - e["y1"]), default=pool[0] if pool else None)
            if pick is None:
                continue
            pick |= {"label": c.label, "label_kind": c.label_kind, "caption": c.caption, "caption_block": int(c.block_no)}
            if table and c.y1 < pick["y1"]:
                pick["y0"] = max(pick["y0"], c.y1 + CAPTION_SLACK)
            elif not table and c.y0 > pick["y0"]:
                pick["y1"] = min(pick["y1"], c.y0 - CAPTION_SLACK)
        return [{c.split()[0]: e[c.split()[0]] for c in BOUND.split(", ")} for e in exhibits]

    return by_page(found.select(*keys, "block_no", "type", "label", "label_kind", "caption", "x0", "y0", "x1", "y1"), list(keys), run, BOUND)


def recovered_figures(found: DataFrame, images: DataFrame | None = None, keys: Sequence[str] = ("book_id", "chapter", "page")) -> DataFrame:
    """Figures for captions marked `unresolved`: the short blocks beside one, up to the next prose, or an image in the gap.

    Returns block_no of the caption, the figure's box and the blocks that it takes the place of.
    """
    frame = found.withColumn("__image", F.lit(False))
    if images is not None:
        blank = {f.name: F.lit(None).cast(f.dataType) for f in frame.schema}
        frame = frame.unionByName(images.select(*(F.col(c) if c in images.columns else F.lit(True).alias(c) if c == "__image" else blank[c].alias(c) for c in frame.columns)))

    def run(pdf: pd.DataFrame) -> list[dict]:
        pictures = pdf[pdf["__image"].astype(bool)]
        rows = list(pdf[~pdf["__image"].astype(bool)].sort_values(["y0", "x0", "block_no"], kind="stable").itertuples(index=False))

        def short(b) -> bool:
            plain = b.type == "paragraph" or (b.type == "caption" and pd.isna(b.label))
            words = len((b.text or "").split())
            return plain and 0 < words <= CONTENT_WORDS

        out = []
        for at, c in enumerate(rows):
            if c.type != "caption" or pd.isna(c.label) or not bool(c.unresolved):
                continue
            beyond = rows[at + 1 :] if c.label_kind == "table" else rows[:at][::-1]
            stop = next((i for i, b in enumerate(beyond) if not short(b)), len(beyond))
            eaten, wall = beyond[:stop], beyond[stop] if stop < len(beyond) else None
            if eaten:
                box = (min(b.x0 for b in eaten), min(b.y0 for b in eaten), max(b.x1 for b in eaten), max(b.y1 for b in eaten))
            else:
                lo, hi = (c.y1, wall.y0 if wall is not None else 792.0) if c.label_kind == "table" else (wall.y1 if wall is not None else 0.0, c.y0)
                fit = pictures[(pictures["y1"] <= hi + CAPTION_SLACK) & (pictures["y0"] >= lo - CAPTION_SLACK)].sort_values("y0", kind="stable")
                if not len(fit):
                    continue
                box = tuple(fit.iloc[0][["x0", "y0", "x1", "y1"]])
            out.append({"block_no": int(c.block_no), "x0": box[0], "y0": box[1], "x1": box[2], "y1": box[3], "replaces": [int(b.block_no) for b in eaten]})
        return out

    return by_page(frame.select(*keys, "block_no", "type", "text", "label", "label_kind", "unresolved", "x0", "y0", "x1", "y1", "__image"), list(keys), run, "block_no int, x0 double, y0 double, x1 double, y1 double, replaces array<int>")


def agreement(found: DataFrame, regions: DataFrame, sources: Sequence[str], keys: Sequence[str] = ("book_id", "chapter", "page")) -> DataFrame:
    """keys, id, agreement and flags of text blocks: the mean likeness to each source's best-overlapping region."""
    k = list(keys)
    text = found.where(F.col("type").isin(*SCORED))
    per: list[DataFrame] = []
    for s in sources:
        pairs = geometry.overlapping(text, regions.where(F.col("source") == s), k, 0.0)
        top = geometry.best(pairs, k, [F.desc("score"), F.col("r_id")]).where((F.col("score") >= OVERLAP_FLOOR) & (F.coalesce("r_text", F.lit("")) != ""))
        a, b = kernel.exact_normal(F.col("text")), kernel.exact_normal(F.col("r_text"))
        norm = top.select(*k, "id", a.alias("a"), b.alias("b"))
        same = (F.col("a") != "") & (F.col("b").contains(F.col("a")) | F.col("a").contains(F.col("b")))
        per.append(norm.withColumn("ratio", kernel.indel_ratio("a", "b") / 100).select(*k, "id", F.lit(s).alias("s"), F.when(same, 1.0).otherwise(F.col("ratio")).alias("ratio")))
    scores = reduce(DataFrame.unionByName, per).groupBy(*k, "id").agg(F.avg("ratio").alias("agreement"), F.collect_set("s").alias("seen"))
    joined = text.select(*k, "id", "text").join(scores, [*k, "id"], "left")
    empty = kernel.strip(F.col("text")) == ""
    missing = F.transform(F.array_except(F.array(*map(F.lit, sources)), F.coalesce("seen", F.array().cast("array<string>"))), lambda s: F.concat(F.lit("missing_in_"), s))
    low = F.when(F.col("agreement") < AGREEMENT_FLOOR, F.array(F.lit("content_disagreement"), F.lit("needs_visual"))).otherwise(F.array().cast("array<string>"))
    return joined.select(*k, "id", F.when(~empty, F.col("agreement")).alias("agreement"), F.when(empty, F.array(F.lit("empty_text"), F.lit("needs_visual"))).otherwise(F.concat(missing, low)).alias("flags"))


def lost_numbers(ours: DataFrame, theirs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Numbers (text) that an extractor has oftener than we, by source: one direction only, over a whole chapter."""
    a = multiset.bag(ours, kernel.numbers(F.col("text")), keys, "number")
    b = multiset.bag(theirs, kernel.numbers(kernel.repair_decimals(F.col("text"))), [*keys, "source"], "number")
    # Only the extractor's numbers can be lost, so ours are looked up by number and not repeated for every source.
    both = b.select(*keys, "source", "number", "n").join(a.select(*keys, "number", F.col("n").alias("__n")), [*keys, "number"], "left")
    return both.withColumn("missing", F.col("n") - F.coalesce("__n", F.lit(0))).where("missing > 0").select(*keys, "source", "number", "missing")


def affected_pages(lost: DataFrame, theirs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, source and the pages on which an extractor has a number that we lost."""
    n = F.array_distinct(kernel.numbers(kernel.repair_decimals(F.col("text"))))
    rows = theirs.select(*keys, "source", "page", F.explode(n).alias("number"))
    return rows.join(lost.select(*keys, "source", "number").distinct(), [*keys, "source", "number"], "left_semi").select(*keys, "source", "page").distinct()


def references(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Numbered references and citations in block texts, with the place each points to, in order."""
    bare = kernel.without_citations(F.col("text"))
    column = lambda i: F.regexp_extract_all(bare, F.lit(REFERENCE), F.lit(i))
    named = F.transform(F.arrays_zip(column(1).alias("a"), column(2).alias("b"), column(3).alias("c"), column(4).alias("d")), lambda m: F.struct(F.when(m["a"] != "", m["a"]).otherwise(m["c"]).alias("kind"), F.when(m["a"] != "", m["b"]).otherwise(m["d"]).alias("number")))
    cited = F.transform(kernel.citations(F.col("text")), lambda n: F.struct(F.lit("citation").alias("kind"), n.cast("string").alias("number")))
    rows = found.select(*keys, F.posexplode(F.concat(cited, named)).alias("place", "r")).select(*keys, "place", "r.*")
    label = F.when(F.col("kind") == "citation", F.col("number")).otherwise(F.concat_ws(" ", "kind", "number"))
    target = F.when(F.col("kind") == "citation", F.concat(F.lit("bibliography#ref-"), F.col("number"))).otherwise(kernel.target_anchor(F.col("kind"), F.col("number")))
    return rows.select(*keys, "place", F.lower("kind").alias("kind"), label.alias("label"), target.alias("target"))


def reference_lines(rows: DataFrame, keys: Sequence[str] = ("book_id", "chapter", "page"), near: float = 20.0, alike: float = 0.1) -> DataFrame:
    """Rows (id, text, size, y0, y1, is_caption, figure, half_figure, furniture, reason) with `removed`: why each is left out.

    Captions stay, and so do the lines that carry one on inside its figure: close below it, of its size.
    `figure` is the figure that holds the row, `half_figure` one that holds half of it, `reason` what rules a row
    out outside captions.
    """

    def run(pdf: pd.DataFrame) -> list[dict]:
        out, inside, bottom, size = [], None, 0.0, 0.0
        for r in pdf.sort_values(["y0", "x0", "id"], kind="stable").itertuples(index=False):
            removed = None
            if r.is_caption:
                inside, bottom, size = (r.figure, r.y1, r.size) if pd.notna(r.figure) else (None, 0.0, 0.0)
            elif inside is not None and r.y0 - bottom <= near and abs(r.size - size) <= alike and r.half_figure == inside:
                removed = r.furniture if pd.notna(r.furniture) else None
                inside, bottom = (None, bottom) if removed else (inside, r.y1)
            else:
                inside = None
                removed = r.reason if pd.notna(r.reason) else None
            out.append({"id": int(r.id), "text": r.text, "removed": removed})
        return out

    return by_page(rows.select(*keys, "id", "text", "size", "x0", "y0", "y1", "is_caption", "figure", "half_figure", "furniture", "reason"), list(keys), run, "id long, text string, removed string")


def line_reason(furniture: Column, opener: Column, figure: Column, equation: Column, text: Column) -> Column:
    """Why a row is no reference text, the first that applies."""
    return F.when(furniture.isNotNull(), furniture).when(opener, "chapter_opener_heading").when(figure, "figure_interior").when(equation, "equation_interior").when(kernel.is_integer_soup(text), "integer_soup")


def reading_order(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Blocks with their place on the page, by y0, x0 and number."""
    return found.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("y0", "x0", "block_no")))


def block_ids(found: DataFrame, keys: Sequence[str] = ("book_id",)) -> DataFrame:
    """Blocks with ids such as ch02-b0001, in the order in which they were made."""
    w = Window.partitionBy(*keys, "chapter").orderBy("block_no")
    return found.withColumn("id", F.concat(kernel.chapter_id(F.col("chapter")), F.lit("-b"), F.format_string("%04d", F.row_number().over(w))))
