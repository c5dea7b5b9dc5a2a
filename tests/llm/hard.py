"""Rows that every operator has to take: nulls, empty and long texts, ties, repeated rows, clashing names."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROSE = "the river carries its water past the old mill and the town below where boats wait for the tide to turn before they leave again"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(30_000))
ROWS = [
    (1, PROSE + " first ending here", "en", "a"), (2, PROSE + " first ending here", "en", "b"), (3, PROSE + " another ending here", "en", None), (4, None, "en", "a"), (5, "", None, "a"), (6, " \t\n\x0b\f\r ", "de", "b"),
    (7, "one", "en", ""), (8, "two words", "en", "c"), (9, LONG, "en", "a"), (10, "été à la mer ÀÉ", "fr", "a"), (None, PROSE + " without an id", None, "b"), (None, None, None, None),
    (11, PROSE + " repeated row", "en", "a"), (11, PROSE + " repeated row", "en", "a"), (12, "123 456", None, "c"), (13, "line\nline\nline\nother", "en", "c"), (14, "   nbsp", "en", "c"),
]


def documents(spark: SparkSession, rows=ROWS) -> DataFrame:
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], SCHEMA)


def clashing(df: DataFrame) -> DataFrame:
    """With further columns whose names operators use themselves."""
    for name in ("size", "n", "rank", "key", "component", "rep", "score", "n_words", "failed_bits", "range", "class", "sid", "target", "taken", "start", "length", "draw", "row", "digest", "wh", "at", "kind", "g"):
        df = df.withColumn(name, F.lit("x"))
    return df


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
