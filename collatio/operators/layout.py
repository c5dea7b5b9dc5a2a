"""Layout of pages: glyphs to lines, lines to rows, sub-captions, figure regions, payoff grids.

Lines have the columns of LINE. What depends on order only row by row is native; greedy clustering,
where each item is compared with the clusters so far, runs as one grouped function for each page.
A page is the unit of all of these, and holds some hundreds of lines.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collatio.functions import kernel

# Distances in points unless said otherwise.
SPACE_GAP, ROW_OVERLAP, FIGURE_OVERLAP = 0.15, 0.6, 0.3
CAPTION_SMALLER, CAPTION_SIZE, CAPTION_COLUMN, CAPTION_BREAK = 1.0, 0.1, 20.0, 40.0
ROW_TOLERANCE, COLUMN_TOLERANCE, HEADER_GAP, LABEL_GAP, CAPTION_GAP, GROUP_GAP = 4.0, 26.0, 34.0, 30.0, 40.0, 3.0
LINE = "line_no int, text string, size double, x0 double, y0 double, x1 double, y1 double, fonts array<string>, small_caps array<string>"
OPENER = re.compile(r"\([a-z]\)\s+")
PAYOFF = re.compile(rf"{kernel.PAYOFF_PART}(?:\s*,\s*{kernel.PAYOFF_PART}){{1,2}}")
PADDED = re.compile(rf"{kernel.SIGN}0{{2,}}")


def lines_of_glyphs(glyphs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines of glyphs (keys, line_no, pos, c, x0, y0, x1, y1, size, font), with a blank where two stand apart."""
    w = Window.partitionBy(*keys, "line_no").orderBy("pos")
    before, reached = F.lag("c").over(w), F.lag("x1").over(w)
    apart = reached.isNotNull() & ~before.endswith(" ") & (F.col("c") != " ") & (F.col("x0") - reached > SPACE_GAP * F.col("size"))
    spaced = glyphs.withColumn("__c", F.when(apart, F.concat(F.lit(" "), F.col("c"))).otherwise(F.col("c")))
    in_order = F.array_sort(F.collect_list(F.struct("pos", "__c", "font")))
    text = F.array_join(F.transform(in_order, lambda g: g["__c"]), "")
    # Words in a small-caps face, glyph runs of one face being joined first.
    caps = F.array_join(F.transform(in_order, lambda g: F.when(kernel.is_small_caps(g["font"]), g["__c"]).otherwise(" ")), "")
    return (
        spaced.groupBy(*keys, "line_no")
        .agg(
            text.alias("text"), F.max("size").alias("size"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
            F.array_sort(F.collect_set("font")).alias("fonts"), F.filter(kernel.fields(caps), lambda x: x.rlike(kernel.TOKEN)).alias("small_caps"),
        )
        .where(kernel.strip(F.col("text")) != "")
    )


def rotated(lines: DataFrame, rotation: str = "rotation", width: str = "page_width", height: str = "page_height") -> DataFrame:
    """Boxes as the page shows them when it is turned by 90, 180 or 270 degrees."""
    x0, y0, x1, y1, w, h, r = (F.col(c) for c in ("x0", "y0", "x1", "y1", width, height, rotation))
    turn = lambda a, b, c, d: F.when(r == 90, a).when(r == 180, b).when(r == 270, c).otherwise(d)
    return lines.withColumns({"x0": turn(h - y1, w - x1, y0, x0), "y0": turn(x0, h - y1, w - x1, y0), "x1": turn(h - y0, w - x0, y1, x1), "y1": turn(x1, h - y0, w - x0, y1)})


def clipped_text(lines: DataFrame, keys: Sequence[str], x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """The text of the lines within a rectangle, in order."""
    inside = lines.where((F.col("x0") >= x0) & (F.col("y0") >= y0) & (F.col("x1") <= x1) & (F.col("y1") <= y1))
    return page_text(inside, keys)


def page_text(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and text: lines in order, one a line."""
    return lines.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), "\n").alias("text"))


def by_page(df: DataFrame, keys: Sequence[str], run: Callable[[pd.DataFrame], list[dict]], schema: str) -> DataFrame:
    """A grouped function: the rows of a page to rows of `schema`, keys in front."""
    names = [c.split()[0] for c in re.split(r", (?=\w+ \w)", schema)]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in keys)

    def grouped(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(run(pdf), columns=names)
        for at, k in enumerate(keys):
            out.insert(at, k, pdf[k].iloc[0])
        return out

    return df.groupBy(*keys).applyInPandas(grouped, f"{types}, {schema}")


class Lines:
    """The lines of a page as arrays, in the order of their rows."""

    def __init__(self, pdf: pd.DataFrame) -> None:
        # Python's rounding, which halves differently from Spark's.
        key = pd.Series([round(y, 1) for y in pdf["y0"]], index=pdf.index)
        self.rows = pdf.assign(__y=key).sort_values(["__y", "x0", "line_no"], kind="stable").drop(columns="__y").reset_index(drop=True)

    def clusters(self, same: Callable[[np.ndarray, int], np.ndarray]) -> np.ndarray:
        """The cluster of each line: the first whose first line is `same`, else one of its own."""
        heads: list[int] = []
        label = np.empty(len(self.rows), int)
        for i in range(len(self.rows)):
            hit = same(np.array(heads, int), i) if heads else np.zeros(0, bool)
            label[i] = int(hit.argmax()) if hit.any() else len(heads)
            if label[i] == len(heads):
                heads.append(i)
        return label

    def visual_rows(self) -> np.ndarray:
        """Lines beside each other by ROW_OVERLAP of the lower one."""
        top, end = self.rows["y0"].to_numpy(), self.rows["y1"].to_numpy()

        def same(heads: np.ndarray, i: int) -> np.ndarray:
            low = np.minimum(end[heads] - top[heads], end[i] - top[i])
            return np.maximum(np.minimum(end[heads], end[i]) - np.maximum(top[heads], top[i]), 0) / np.where(low > 0, low, 1.0) >= ROW_OVERLAP

        return self.clusters(same)


def _one(lines: pd.DataFrame, text: str) -> dict:
    """Several lines as one."""
    fonts = sorted({f for fs in lines["fonts"] for f in fs})
    return {"line_no": int(lines["line_no"].min()), "text": text, "size": float(lines["size"].max()), "x0": lines["x0"].min(), "y0": lines["y0"].min(), "x1": lines["x1"].max(), "y1": lines["y1"].max(), "fonts": fonts, "small_caps": [w for ws in lines["small_caps"] for w in ws]}


def merged_rows(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines that share a visual row as one line, its parts from left to right."""

    def run(pdf: pd.DataFrame) -> list[dict]:
        page = Lines(pdf)
        parts = page.rows.groupby(page.visual_rows(), sort=True)
        return [_one(p, " ".join(p["text"])) for p in (g.sort_values("x0", kind="stable") for _, g in parts)]

    return by_page(lines, keys, run, LINE)


def join_hyphenated(left: str, right: str, known: set[str]) -> str:
    """The same as kernel.join_hyphenated, for folds."""
    if re.search(r"\d–\Z", left) and right[:1].isdigit():
        return left + right
    if not left.endswith("-"):
        return f"{left} {right}"
    whole = f"{re.split(r'\s', left[:-1])[-1]}-{re.split(r'\s', right)[0].strip('.,;:)')}".lower()
    return left + right if whole in known else left[:-1] + right


def _caption_columns(page: pd.DataFrame, body: float) -> list[list[int]]:
    """The rows of `page` that make up each sub-caption of a grid whose openers stand side by side."""
    small = Lines(page[page["size"] < body - CAPTION_SMALLER])
    done: list[list[int]] = []
    grid: list[list[int]] = []

    def close() -> None:
        if any(len(c) > 1 for c in grid):
            done.extend(grid)

    rows, label = small.rows, small.visual_rows()
    order = sorted((g["y0"].min(), k) for k, g in rows.groupby(label))
    for _, k in order:
        row = rows[label == k].sort_values("x0", kind="stable")
        if len(row) >= 2 and all(OPENER.match(t.strip()) for t in row["text"]):
            close()
            grid = [[i] for i in row.index]
            continue
        like = row[(row["size"] - np.mean([rows.at[c[0], "size"] for c in grid] or [np.inf])).abs() <= CAPTION_SIZE] if grid else row[:0]
        if not len(like):
            continue
        if like["y0"].iloc[0] - max(rows.at[i, "y0"] for c in grid for i in c) > CAPTION_BREAK:
            close()
            grid = []
            continue
        for i, x in like["x0"].items():
            away = [abs(x - rows.at[c[0], "x0"]) for c in grid]
            if min(away) <= CAPTION_COLUMN:
                grid[int(np.argmin(away))].append(i)
    close()
    numbers = rows["line_no"]
    return [[int(numbers[i]) for i in c] for c in done]


def reflowed(lines: DataFrame, keys: Sequence[str], body: str = "body_size", known: str = "known_hyphens") -> DataFrame:
    """Lines with each sub-caption of a grid as one line, marked `consolidated`; the rest as it was.

    `body` and `known`, columns of the lines, are the page's body size and its document's hyphenated forms.
    """

    def run(pdf: pd.DataFrame) -> list[dict]:
        found = _caption_columns(pdf, float(pdf[body].iloc[0]))
        hyphens = pdf[known].iloc[0]
        forms = set(hyphens) if hyphens is not None else set()
        taken = {n for c in found for n in c}
        rest = [_one(pdf[pdf["line_no"] == n], t) | {"consolidated": False} for n, t in zip(pdf["line_no"], pdf["text"], strict=True) if n not in taken]
        by_no = pdf.set_index("line_no", drop=False)
        columns = [by_no.loc[c] for c in found]
        return rest + [_one(c, reduce(lambda a, b: join_hyphenated(a, b, forms), c["text"])) | {"size": float(c["size"].iloc[0]), "consolidated": True} for c in columns]

    return by_page(lines, keys, run, LINE + ", consolidated boolean")


def figure_regions(regions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Figure boxes (region_no, x0, y0, x1, y1, source) that overlap, as the box around them; it grows as they join."""

    def run(pdf: pd.DataFrame) -> list[dict]:
        out: list[dict] = []
        for r in pdf.sort_values(["y0", "region_no"], kind="stable").itertuples():
            for m in out:
                shared = max(0.0, min(m["x1"], r.x1) - max(m["x0"], r.x0)) * max(0.0, min(m["y1"], r.y1) - max(m["y0"], r.y0))
                smaller = min((m["x1"] - m["x0"]) * (m["y1"] - m["y0"]), (r.x1 - r.x0) * (r.y1 - r.y0)) or 1.0
                if shared / smaller > FIGURE_OVERLAP:
                    m |= {"x0": min(m["x0"], r.x0), "y0": min(m["y0"], r.y0), "x1": max(m["x1"], r.x1), "y1": max(m["y1"], r.y1)}
                    m["source"] = m["source"] if r.source in m["source"].split("+") else f"{m['source']}+{r.source}"
                    break
            else:
                out.append({"region_no": int(r.region_no), "x0": r.x0, "y0": r.y0, "x1": r.x1, "y1": r.y1, "source": r.source})
        return out

    return by_page(regions, keys, run, "region_no int, x0 double, y0 double, x1 double, y1 double, source string")


class Grids:
    """The payoff grids of a page's unmerged lines."""

    def __init__(self, pdf: pd.DataFrame, figure_tops: Sequence[float], table_bottoms: Sequence[float]) -> None:
        self.lines = pdf.reset_index(drop=True)
        text = self.lines["text"].str.strip()
        self.payoff = text.map(lambda t: bool(PAYOFF.fullmatch(t)) and not any(PADDED.fullmatch(p.strip()) for p in t.split(","))).to_numpy(bool)
        faces = lambda hints: self.lines["fonts"].map(lambda fs: any(h in f for f in fs for h in hints)).to_numpy(bool)
        self.cell = self.payoff & faces(kernel.MATH_FACES)
        self.x0, self.y0, self.x1, self.y1 = (self.lines[c].to_numpy(float) for c in ("x0", "y0", "x1", "y1"))
        self.mid = (self.x0 + self.x1) / 2
        self.tops, self.bottoms = figure_tops, table_bottoms

    def text(self, i: int) -> str:
        return re.sub(r"\s+", " ", self.lines["text"][i]).strip().replace("|", "\\|")

    def rows(self, cells: np.ndarray) -> list[np.ndarray]:
        """Cells whose tops are near that of the row's first one, from left to right."""
        out: list[list[int]] = []
        for i in sorted(cells.tolist(), key=lambda i: (self.y0[i], self.x0[i])):
            near = [r for r in out if abs(self.y0[r[0]] - self.y0[i]) <= ROW_TOLERANCE]
            near[0].append(i) if near else out.append([i])
        return [np.array(sorted(r, key=lambda i: self.x0[i])) for r in out]

    def groups(self) -> list[tuple[list[np.ndarray], bool]]:
        """Rows of a grid each, and whether it is one cell or row that only a caption beside it makes one."""
        blocks: list[list[np.ndarray]] = []
        for row in self.rows(np.flatnonzero(self.cell)):
            last = blocks[-1][-1][0] if blocks else None
            if last is not None and self.y0[row[0]] - self.y1[last] <= GROUP_GAP * (self.y1[last] - self.y0[last]):
                blocks[-1].append(row)
            else:
                blocks.append([row])
        out = []
        for b in blocks:
            flat = np.concatenate(b)
            low, high = self.y1[flat].max(), self.y0[flat].min()
            captioned = any(0 <= t - low <= CAPTION_GAP for t in self.tops) or any(0 <= high - t <= CAPTION_GAP for t in self.bottoms)
            if len(b) >= 2 or captioned:
                out.append((b, len(b) < 2))
        return out

    def centres(self, rows: list[np.ndarray]) -> np.ndarray:
        """The middles of the columns: by place if all rows are as long, else by nearness."""
        if len({len(r) for r in rows}) == 1:
            return np.mean([self.mid[r] for r in rows], axis=0)
        out: list[float] = []
        for m in self.mid[sorted(np.concatenate(rows).tolist(), key=lambda i: self.x0[i])]:
            k = next((k for k, c in enumerate(out) if abs(c - m) <= COLUMN_TOLERANCE), None)
            if k is None:
                out.append(float(m))
            else:
                out[k] = (out[k] + float(m)) / 2
        return np.array(sorted(out))

    @staticmethod
    def column(centres: np.ndarray, x: float) -> int | None:
        away = np.abs(centres - x)
        return int(away.argmin()) if len(away) and away.min() < COLUMN_TOLERANCE else None

    def cells(self) -> list[dict]:
        """The cells of all candidate grids with their row and column (null if it is near none) and the columns' middles."""
        out = []
        for g, (rows, alone) in enumerate(self.groups()):
            centres = self.centres(rows)
            out += [
                {"grid": g, "alone": alone, "r": r, "c": self.column(centres, self.mid[i]), "n_rows": len(rows), "centres": centres.tolist(), "line_no": int(self.lines["line_no"][i])}
                for r, row in enumerate(rows) for i in row.tolist()
            ]
        return out


CELLS = "grid int, alone boolean, r int, c int, n_rows int, centres array<double>, line_no int"


def _nearest_line(pairs: DataFrame, by: list[str], far: Column, named: str) -> DataFrame:
    """Of the lines that are paired with a row of `by`, the least far one, the first of equal ones, as a struct."""
    line = F.struct("line_no", "label", "x0", "y0", "x1", "y1")
    return pairs.groupBy(*by).agg(F.min_by(line, F.struct(far.alias("far"), F.col("line_no").alias("n"))).alias(named))


def matrices(lines: DataFrame, keys: Sequence[str], tops: str = "figure_tops", bottoms: str = "table_bottoms") -> DataFrame:
    """The payoff grids of pages; `tops` and `bottoms` are columns with where the page's captions begin and end.

    Cells are gathered into grids page by page. What stands beside and above a grid is found by joins of its rows and
    columns with the page's lines: a name for each row and column, and then the two players outside them.
    """
    k = list(keys)

    def run(pdf: pd.DataFrame) -> list[dict]:
        ends = [pdf[c].iloc[0] if c in pdf else None for c in (tops, bottoms)]
        return Grids(pdf, *(list(e) if e is not None else [] for e in ends)).cells()

    short = F.length(kernel.strip(F.col("text")))
    payoff, italic = kernel.is_payoff(F.col("text")), kernel.is_italic(F.col("fonts"))
    here = lines.select(
        *k, "line_no", kernel.clean_cell(F.col("text")).alias("label"), *(F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")), ((F.col("x0") + F.col("x1")) / 2).alias("mid"),
        (~payoff & ~kernel.is_bare_decimal(F.col("text")) & (italic | (short <= kernel.HEADER_LETTERS))).alias("names"), (~payoff & (~italic | (short <= 3))).alias("plays"),
    )
    cells = by_page(lines, k, run, CELLS).join(here, [*k, "line_no"])
    one = [*k, "grid"]
    grids = (
        cells.groupBy(*one, "alone", "n_rows", "centres").agg(F.min("x0").alias("left"), F.max("x1").alias("right"), F.min("y0").alias("top"), F.max("y1").alias("bottom"), F.count_if(F.col("c").isNull()).alias("__astray"), F.array_sort(F.collect_list(F.struct("r", F.col("x0").alias("x"), "c", "label"))).alias("body"))
        .where((F.col("__astray") == 0) & (F.col("alone") | ((F.col("n_rows") >= 2) & (F.size("centres") >= 2)))).drop("__astray")
    )
    named = here.where("names").drop("names", "plays")
    edges = cells.groupBy(*one, "r").agg(F.min_by(F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct("x0", "line_no")).alias("edge"))
    level = edges.join(named, k).where((F.abs(F.col("y0") - F.col("edge.y")) <= ROW_TOLERANCE) & (F.col("x1") <= F.col("edge.x") + 2.0))
    row_names = _nearest_line(level, [*one, "r"], -F.col("x1"), "name")
    above = F.col("top") - F.col("y1")
    column = F.array_min(F.transform("centres", lambda c, i: F.struct(F.abs(c - F.col("mid")).alias("away"), i.alias("c"))))
    over = grids.select(*one, "top", "centres").join(named, k).where((above >= 0) & (above <= HEADER_GAP)).withColumn("__at", column).where(F.col("__at.away") < COLUMN_TOLERANCE).withColumn("c", F.col("__at.c"))
    column_names = _nearest_line(over, [*one, "c"], above, "name")
    gathered = lambda found, at, name: found.groupBy(*one).agg(F.array_sort(F.collect_list(F.struct(at, "name"))).alias(name))
    none = lambda name, of: F.coalesce(name, F.array().cast(of.schema[name].dataType)).alias(name)
    by_row, by_column = gathered(row_names, "r", "side"), gathered(column_names, "c", "heads")
    named_grids = grids.join(by_row, one, "left").join(by_column, one, "left").select(*grids.columns, none("side", by_row), none("heads", by_column))
    both = (F.size("side") == F.col("n_rows")) & (F.size("heads") == F.size("centres"))
    named_grids = named_grids.where(F.when(F.col("alone"), both).otherwise((F.size("side") > 0) | (F.size("heads") > 0)))
    named_grids = named_grids.withColumn("left", F.least("left", F.array_min(F.col("side.name.x0")))).withColumn("head_top", F.least("top", F.array_min(F.col("heads.name.y0"))))
    outside = named_grids.select(*one, "left", "right", "top", "bottom", "head_top").join(here.where("plays").drop("names", "plays"), k)
    gap = F.col("head_top") - F.col("y1")
    upper = _nearest_line(outside.where((gap > 0) & (gap <= LABEL_GAP) & F.col("mid").between(F.col("left") - 40, F.col("right") + 40)), one, gap, "over")
    lower = _nearest_line(outside.where((F.col("x1") <= F.col("left") + 2.0) & F.col("y1").between(F.col("top") - ROW_TOLERANCE, F.col("bottom") + ROW_TOLERANCE)), one, -F.col("x1"), "beside")
    whole = named_grids.join(upper, one, "left").join(lower, one, "left")
    label = lambda found, at, n: F.coalesce(F.get(F.filter(found, lambda v: v[at] == n), F.lit(0))["name"]["label"], F.lit(""))
    places = F.sequence(F.lit(0), F.size("centres") - 1)
    cell = lambda r, c: F.coalesce(F.try_element_at(F.filter("body", lambda v: (v["r"] == r) & (v["c"] == c)), F.lit(-1))["label"], F.lit(""))
    body = F.transform(F.sequence(F.lit(0), F.col("n_rows") - 1), lambda r: F.concat(F.array(label("side", "r", r)), F.transform(places, lambda c: cell(r, c))))
    corner = F.concat_ws(" \\ ", F.col("beside.label"), F.col("over.label"))
    table = F.concat(F.array(F.concat(F.array(corner), F.transform(places, lambda c: label("heads", "c", c)))), body)
    lines_of = cells.groupBy(*one).agg(F.collect_list(F.struct("line_no", "label", "x0", "y0", "x1", "y1")).alias("own"))
    some = lambda c: F.when(F.col(c).isNull(), F.array().cast(lines_of.schema["own"].dataType)).otherwise(F.array(c))
    whole = whole.join(lines_of, one).withColumn("used", F.concat("own", F.col("side.name"), F.col("heads.name"), some("over"), some("beside")))
    number = F.row_number().over(Window.partitionBy(*k).orderBy("grid")) - 1
    blank = lambda c: F.nullif(F.col(f"{c}.label"), F.lit(""))
    return whole.select(
        *k, number.cast("int").alias("matrix_no"), table.alias("cells"), blank("beside").alias("row_player"), blank("over").alias("col_player"),
        F.array_min("used.x0").alias("x0"), F.array_min("used.y0").alias("y0"), F.array_max("used.x1").alias("x1"), F.array_max("used.y1").alias("y1"), F.array_sort(F.array_distinct("used.line_no")).alias("line_nos"),
    )


def payoff_census(lines: DataFrame, keys: Sequence[str], tops: str = "figure_tops", bottoms: str = "table_bottoms") -> DataFrame:
    """The payoff cells of grids with two columns or more, or a caption, found without building any."""

    def run(pdf: pd.DataFrame) -> list[dict]:
        ends = [pdf[c].iloc[0] if c in pdf else None for c in (tops, bottoms)]
        g = Grids(pdf, *(list(e) if e is not None else [] for e in ends))
        return [{"cell": g.text(int(i))} for rows, alone in g.groups() if alone or len(g.centres(rows)) >= 2 for r in rows for i in r]

    return by_page(lines, keys, run, "cell string")


def long_cells(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matrices as (keys, matrix_no, r, c, value)."""
    rows = found.select(*keys, "matrix_no", F.posexplode("cells").alias("r", "row"))
    return rows.select(*keys, "matrix_no", "r", F.posexplode("row").alias("c", "value"))


def placement(cells: DataFrame, lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, id and placed: whether a cell's text stands level with its row header and below its column header.

    Cells have id, text, row_header, col_header and the box of their block.
    """
    middle = (F.col("x0") + F.col("x1")) / 2
    here = lines.select(*keys, F.col("text").alias("t"), F.col("y0").alias("ly"), middle.alias("lx"))
    inside = (F.col("ly") >= F.col("y0") - 2) & (F.col("ly") <= F.col("y1") + 2)

    def at(what: str, y: str, x: str) -> DataFrame:
        return cells.join(here, (F.col(what) == F.col("t")) & _same(cells, here, keys)).where(inside).select(*(cells[k] for k in keys), "id", F.col("ly").alias(y), F.col("lx").alias(x))

    met = at("text", "cy", "cx").join(at("row_header", "ry", "rx"), [*keys, "id"]).join(at("col_header", "hy", "hx"), [*keys, "id"])
    ok = (F.abs(F.col("cy") - F.col("ry")) <= ROW_TOLERANCE) & (F.abs(F.col("cx") - F.col("hx")) <= COLUMN_TOLERANCE) & (F.col("rx") < F.col("cx")) & (F.col("hy") < F.col("cy"))
    placed = met.groupBy(*keys, "id").agg(F.bool_or(ok).alias("placed"))
    return cells.select(*keys, "id").join(placed, [*keys, "id"], "left").withColumn("placed", F.coalesce("placed", F.lit(False)))


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    return reduce(lambda x, y: x & y, (a[k] == b[k] for k in keys))
