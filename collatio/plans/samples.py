"""A small book as literal tables, for operators that need geometry: two pages with a heading, a captioned grid, notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.operators.layout import LINE

ROMAN, ITALIC, MATH = ["CMR10"], ["CMTI10"], ["CMMI10"]


def _line(no: int, text: str, x0: float, y0: float, x1: float, size: float = 10.0, fonts: list[str] = ROMAN, height: float = 10.0) -> tuple:
    return (no, text, float(size), float(x0), float(y0), float(x1), float(y0 + height), fonts, [])


#: Page 1 has a running head, a section and a paragraph that wraps; page 2 a 2 x 2 grid, its caption, a footnote and a folio.
PAGES: dict[int, list[tuple]] = {
    1: [
        _line(1, "CHAPTER 6. GAMES", 100, 30, 300, 9), _line(2, "155", 480, 30.2, 500, 9),
        _line(3, "6.1", 100, 80, 130, 14, ROMAN, 14), _line(4, "What is a Game?", 150, 80.5, 300, 14, ROMAN, 14),
        _line(5, "Players choose strategies in a net-", 100, 110, 500), _line(6, "work and receive payoffs, see Figure 6.1.", 100, 122, 500),
        _line(7, "The well-known case has 2 players and 4 outcomes [12].", 100, 150, 500),
    ],
    2: [
        _line(1, "You", 60, 220, 85), _line(2, "Your Partner", 210, 180, 290), _line(3, "Left", 200, 200, 230, 10, ITALIC), _line(4, "Right", 270, 200, 300, 10, ITALIC),
        _line(5, "Up", 120, 215, 140, 10, ITALIC), _line(6, "90, 90", 195, 215, 235, 10, MATH), _line(7, "86, 92", 265, 215, 305, 10, MATH),
        _line(8, "Down", 115, 230, 142, 10, ITALIC), _line(9, "92, 86", 195, 230, 235, 10, MATH), _line(10, "88, 88", 265, 230, 305, 10, MATH),
        _line(11, "Figure 6.1: A small game.", 150, 260, 350, 9.5), _line(12, "After the game, the players part.", 100, 300, 500),
        _line(13, "1 A note about the game.", 100, 600, 400, 8), _line(14, "156", 290, 760, 310, 9),
    ],
}


def lines(spark: SparkSession) -> DataFrame:
    rows = [("book", 6, page, *line) for page, ls in PAGES.items() for line in ls]
    return spark.createDataFrame(rows, f"book_id string, chapter int, page int, {LINE}").withColumn("page_height", F.lit(792.0))


def boxes(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "book_id string, chapter int, page int, id long, x0 double, y0 double, x1 double, y1 double")


def region_sets(spark: SparkSession) -> dict[str, DataFrame]:
    """What extractors boxed on the pages."""
    at = lambda page, id, *box: ("book", 6, page, id, *map(float, box))
    return {
        "captions": boxes(spark, [at(2, 1, 148, 258, 352, 272)]),
        "texts": boxes(spark, [at(1, 1, 98, 108, 502, 134), at(1, 2, 98, 148, 502, 162), at(2, 3, 98, 298, 502, 312), at(2, 4, 148, 258, 352, 272)]),
        "figures": boxes(spark, []), "matrices": boxes(spark, [at(2, 1, 58, 178, 306, 242)]), "equations": boxes(spark, []),
    }
