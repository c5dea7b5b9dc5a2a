"""The text kernel on literal rows, among them what the generated tables never hold."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from collatio.functions import kernel as k
from collatio.functions import markdown as m
from collatio.operators import layout


def value(spark, column, **given):
    return spark.range(1).select(*(F.lit(v).alias(n) for n, v in given.items())).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("net-\nwork", "network"), ("Erd¨os", "erdös"), ("Erdös", "erdös"), ("eﬃcient ﬂow ﬁt", "efficient flow fit"), ("“a” ‘b’ ′", "\"a\" 'b' '"),
        ("a–b−c", "a-b-c"), ("A    B\x1c", "a b"), ("½ １２", "1⁄2 12"), ("soft­\n hyphen", "softhyphen"), ("", ""), (None, None),
    ],
)
def test_exact_normal(spark, text, want):
    assert value(spark, k.exact_normal(F.col("t")), t=text) == want


def test_native_normal_is_exact_on_stable_text(spark):
    rs = random.Random(1)
    texts = ["".join(rs.choice("abÉß \n-–“ﬁZ09_.­\t") for _ in range(rs.randint(0, 40))) for _ in range(300)]
    texts = [t for t in texts if unicodedata.normalize("NFC", t) == t]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~k.normal(F.col("t")).eqNullSafe(k.exact_normal(F.col("t")))).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("shares .48, not .12", ["0.48", "0.12"]), ("the 500th and 501st", ["500", "501"]), ("seen [421] twice", []), ("2.0 and 2", ["2", "2"]), ("x86 a1 3.14.15", ["3.14"]), ("10.50 007", ["10.5", "007"]), ("", []),
    ],
)
def test_numbers(spark, text, want):
    assert value(spark, k.numbers(F.col("t")), t=text) == want


def test_numbers_against_python(spark):
    rs = random.Random(2)
    texts = ["".join(rs.choice("012.9 a[,]t́hs_-") for _ in range(rs.randint(0, 30))) for _ in range(500)]

    def plain(t):
        t = re.sub(r"\s+", " ", unicodedata.normalize("NFC", t)).strip().lower()
        t = re.sub(r"\[\s*\d{1,3}(?:\s*,\s*\d{1,3})*\s*\]", " ", t)
        out = []
        for x in re.finditer(r"(?<![\w.])(?:\d+(?:\.\d+)?|\.\d+)(?:st|nd|rd|th)?(?!\w)", t):
            n = re.sub("(st|nd|rd|th)$", "", x.group())
            n = "0" + n if n.startswith(".") else n
            out.append(re.sub(r"\.$", "", re.sub("0+$", "", n)) if "." in n else n)
        return out

    texts = [t for t in texts if "́" not in t]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", k.numbers(F.col("t")).alias("n")).collect()
    assert all(r.n == plain(r.t) for r in got)


def test_citations(spark):
    assert value(spark, k.citations(F.col("t")), t="as [12] and [7, 8] say [1234]") == [12, 7, 8]
    assert value(spark, k.without_citations(F.col("t")), t="as [12] say") == "as   say"


def test_soup(spark):
    soup = lambda t: value(spark, k.is_integer_soup(F.col("t")), t=t)
    assert soup("1 2 3 4 5 6 7 8 9 10 11") and soup("−65 −51 3.5 4 5 6")
    assert not soup("1 2 3") and not soup("In 1872 the 12 players met 3 times, 4 won.") and not soup("0 0 0 0 0 0 1")
    letters = lambda t: value(spark, k.is_letter_soup(F.col("t")), t=t)
    assert letters("12 aaabbbb aaabbb") and not letters("abcabc") and not letters("an ordinary note")


def test_hyphens(spark):
    assert value(spark, k.hyphenated_forms(F.col("t")), t="A well-known Net-Work, x-ray") == ["net-work", "well-known"]
    join = lambda a, b: value(spark, k.join_hyphenated(F.col("a"), F.col("b"), F.array(F.lit("well-known"))), a=a, b=b)
    for a, b, want in (("a well-", "known case", "a well-known case"), ("a net-", "work", "a network"), ("1872–", "81", "1872–81"), ("one", "two", "one two")):
        assert join(a, b) == want == layout.join_hyphenated(a, b, {"well-known"})


def test_output_form(spark):
    assert value(spark, k.output_form(F.col("t")), t="eﬃcient Erd¨os–A") == "efficient Erdös–A"


def test_labels(spark):
    assert value(spark, k.label_key(F.col("t")), t="14.10") == [14, 10] and value(spark, k.label_key(F.col("t")), t="a.1") == [0]
    assert value(spark, k.target_chapter(F.col("t")), t="Equation (14.1)") == 14 and value(spark, k.target_chapter(F.col("t")), t="Exercise 2") is None
    assert value(spark, k.printed_page(F.col("n"), F.col("c")), n=9, c=0) == "ix" and value(spark, k.printed_page(F.col("n"), F.col("c")), n=9, c=3) == "9"
    assert value(spark, k.slug(F.col("t")), t="Paths & Long  Cycles!") == "paths-long-cycles"


def test_payoffs(spark):
    pay = lambda t: value(spark, k.is_payoff(F.col("t")), t=t)
    assert all(map(pay, ("90, 90", "+1, −1", ".48, .12", "1, 2, 3", "a, a", "(a, b)+, (a, b)+")))
    assert not any(map(pay, ("200, 000", "90", "AA, AB", "see 1, 2 here")))
    assert value(spark, k.canonical_payoff(F.col("t")), t="+1 , −.5") == "1, -0.5"


def test_alt_text(spark):
    alt = lambda t: value(spark, k.alt_text(F.col("t")), t=t)
    assert alt("A [12] game , shown") == "A game, shown" and alt(None) == k.NO_CAPTION and len(alt("word " * 80)) <= 240 and alt("word " * 80).endswith("…")


def test_small_caps(spark):
    got = value(spark, k.small_caps_spans(F.col("t"), F.array(F.lit("mit"), F.lit("mit,"), F.lit("a"))), t="at mit, not permit")
    assert got == 'at <span class="node">mit</span>, not permit'


def test_indel(spark):
    assert value(spark, k.indel_ratio(F.col("a"), F.col("b")), a="abcd", b="abxd") == 75.0
    assert value(spark, k.indel_ratio(F.col("a"), F.col("b")), a="", b="") == 100.0


def test_latex(spark):
    bad = lambda t: value(spark, k.malformed_latex(F.col("t")), t=t)
    assert bad("{x") and bad("\\begin{a}") and not bad("\\begin{a}{x}\\end{a}")
    assert value(spark, k.tagged_equation(F.col("t")), t="x = 1 \\quad (14.10)") == "x = 1 \\tag{14.10}"


def test_markdown(spark):
    page = "---\nid: x\n---\n\n# Title\n\n## 2.1 Graphs {#sec-2-1}\n\nA **bold** [link](/a#b) and ![alt](/img/a.png) $x\\alpha$ $5 to $6\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n\n> note\n<!-- gone -->\n```\ncode\n```\n<span class=\"figure-data\">7</span>"
    words = value(spark, k.tokens(m.plain_text(F.col("t"))), t=page)
    assert words == ["2", "1", "graphs", "a", "bold", "link", "and", "5", "to", "6", "a", "b", "1", "2", "note", "7"]
    assert "7" not in value(spark, k.tokens(m.plain_text(F.col("t"), True)), t=page)
    assert value(spark, m.anchors(F.col("t")), t=page) == ["sec-2-1"]
    assert [tuple(x) for x in value(spark, m.links(F.col("t")), t="[a](/x/#y) [b](/img/f.png) [c](/)")] == [("/x", "y"), ("/", None)]
    route = lambda p, t: value(spark, m.route(F.col("p"), F.col("t")), p=p, t=t)
    assert route("p/02-graphs.md", "") == "/p/graphs" and route("index.md", "---\nslug: /\n---\n") == "/" and route("p/02-g.md", "---\nid: other\n---\n") == "/p/other"
