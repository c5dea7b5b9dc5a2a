"""Column functions over text: one definition of normal form, tokens, numbers and labels for both sides of a comparison.

All are native expressions but `exact_normal`, `output_form` and `indel_ratio`, which need Unicode
composition or a subsequence length and run as Arrow UDFs. `normal` is the same as `exact_normal` for
texts that NFC and NFKC leave alone and that hold no spacing accents before letters.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters, patterns and bounds that results depend on.
SPACING_ACCENTS = {"\u00a8": "\u0308", "\u00b4": "\u0301", "\u02dd": "\u030b", "\u02c6": "\u0302", "\u02c7": "\u030c", "\u02dc": "\u0303", "\u00b8": "\u0327", "\u02da": "\u030a"}
LIGATURES = {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb05": "st"}
SINGLE_QUOTES, DOUBLE_QUOTES = "\u2018\u2019\u2032", "\u201c\u201d"
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2212"
SMALL_CAPS_FACES = ("CSC", "SmallCaps", "SC10", "SC12")
SOUP_FIELDS, SOUP_RATIO, SOUP_REPEAT = 6, 0.8, 0.5
LETTER_SOUP_LETTERS, LETTER_SOUP_DISTINCT = 10, 3
ALT_LIMIT = 240
#: Characters that every Unicode normal form leaves alone wherever they stand, and that are no spacing accents.
COMPOSED = r"\x00-\x7F\xA1-\xA7\xA9\xAB-\xAE\xB0\xB1\xB6\xB7\xBB\xBF-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E\u0410-\u044F\u2012-\u2016\u2018-\u2022\u2212\u3041-\u3096\u4E00-\u9FFF"
WHITE = r"\t\n\x0B\f\r \x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
TOKEN = r"[\p{L}\p{N}]+"
CITATION = rf"\[[{WHITE}]*(?U:\d){{1,3}}(?:[{WHITE}]*,[{WHITE}]*(?U:\d){{1,3}})*[{WHITE}]*\]"
NUMBER = r"(?U)(?<![\w.])(?:\d+(?:\.\d+)?|\.\d+)(?:st|nd|rd|th)?(?!\w)"
BARE_NUMBER = r"(?U)^[-\u2212]?\d+(?:\.\d+)?$"
NUMBER_PAIR = rf"\p{{Nd}}[{WHITE}]+[-\u2212]?\p{{Nd}}"
WORDS_ACROSS = rf"[\p{{L}}\p{{N}}_][\u00AD\-][{WHITE}]*\n[{WHITE}]*[\p{{L}}\p{{N}}_]"
NUMBERS_ACROSS = rf"{WORDS_ACROSS}|\[[{WHITE}\p{{Nd}},]*\n"
HYPHENATED = r"(?U)\b[A-Za-z]{2,}-[A-Za-z]{2,}\b"
FOLIO = r"^(?i:\d{1,4}|[ivxlcdm]{1,7})$"
NO_CAPTION = "Figure from the text; see the surrounding discussion."
MATH_FACES, ITALIC_FACES = ("CMMI", "CMSY", "CMEX", "NewBaskerville"), ("CMTI", "CMMI", "Italic", "Oblique")
HEADER_LETTERS = 20
SIGN = r"[-+\u2212\u2013]?"
PAYOFF_PART = rf"(?:{SIGN}(?:\d+(?:\.\d+)?|\.\d+)(?:/\d+)?|{SIGN}[a-z](?:['\u2032]|_?[a-zA-Z\d])?|\(\s*[a-zA-Z]\s*,\s*[a-zA-Z]\s*\)\+)"
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x")


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, rf"^[{WHITE}]+|[{WHITE}]+\z", "")


def collapsed(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, rf"[{WHITE}]+", " "))


def fields(text: Column) -> Column:
    """Parts between white space."""
    return F.filter(F.split(text, rf"[{WHITE}]+"), lambda x: x != "")


def _styled(text: Column) -> Column:
    """Ligatures spelt out, quotes and dashes plain."""
    for one, many in LIGATURES.items():
        text = F.replace(text, F.lit(one), F.lit(many))
    return F.translate(text, SINGLE_QUOTES + DOUBLE_QUOTES + DASHES, "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES) + "-" * len(DASHES))


def _unbroken(text: Column) -> Column:
    """Words that a line end parted after a hyphen, put together."""
    return F.when(~text.contains("\n"), text).otherwise(_rejoined(text))


def _rejoined(text: Column) -> Column:
    return F.regexp_replace(text, rf"([\p{{L}}\p{{N}}_])[\u00AD\-][{WHITE}]*\n[{WHITE}]*([\p{{L}}\p{{N}}_])", "$1$2")


def normal(text: Column) -> Column:
    """The form in which texts are compared, for text that is stable under NFC and NFKC."""
    plain = ~text.rlike(f"[{SINGLE_QUOTES}{DOUBLE_QUOTES}{DASHES}{''.join(LIGATURES)}]")
    return F.lower(collapsed(F.when(plain, _unbroken(text)).otherwise(_styled(_unbroken(text)))))


def _composed(text: str, form: str) -> str:
    """Spacing accents joined to the letter behind them, in a Unicode normal form."""
    if text.isascii():
        return text
    out: list[str] = []
    i = 0
    while i < len(text):
        mark = SPACING_ACCENTS.get(text[i])
        follower = text[i + 1 : i + 2]
        if mark and follower.isascii() and follower.isalpha():
            out.append(unicodedata.normalize("NFC", follower + mark))
            i += 2
        else:
            out.append(text[i])
            i += 1
    return unicodedata.normalize(form, "".join(out))


@F.pandas_udf(T.StringType())
def composed(text: pd.Series) -> pd.Series:
    """Accents repaired, NFC."""
    return text.map(lambda s: _composed(s, "NFC"), na_action="ignore")


@F.pandas_udf(T.StringType())
def compatible(text: pd.Series) -> pd.Series:
    """NFKC."""
    return text.map(lambda s: s if s.isascii() else unicodedata.normalize("NFKC", s), na_action="ignore")


def exact_normal(text: Column) -> Column:
    """The form in which texts are compared, for any text."""
    # Python sees only texts with characters that composition may change.
    odd = F.when(text.rlike(f"[^{COMPOSED}]"), text)
    return F.coalesce(F.lower(collapsed(compatible(_styled(_rejoined(composed(odd)))))), normal(text))


def output_form(text: Column) -> Column:
    """Text as it is printed: accents repaired, ligatures spelt out."""
    out = composed(text)
    for one, many in LIGATURES.items():
        out = F.replace(out, F.lit(one), F.lit(many))
    return out


def tokens_of(normal_text: Column) -> Column:
    return F.regexp_extract_all(normal_text, F.lit(TOKEN), F.lit(0))


def tokens(text: Column) -> Column:
    return tokens_of(normal(text))


def n_tokens(text: Column) -> Column:
    """How many tokens: they are runs of letters and digits before and after normalisation, but for a line end that joins and a capital that falls apart."""
    changed = text.contains("\n") | text.contains("\u0130")
    return F.when(changed, F.size(tokens(text))).otherwise(F.regexp_count(text, F.lit(TOKEN)))


def citations(text: Column) -> Column:
    """The numbers in bracketed citations, in order."""
    found = F.regexp_extract_all(text, F.lit(CITATION), F.lit(0))
    return F.flatten(F.transform(found, lambda c: F.transform(F.regexp_extract_all(c, F.lit(r"(?U)\d+"), F.lit(0)), lambda d: d.cast("int"))))


def without_citations(text: Column) -> Column:
    return F.regexp_replace(text, CITATION, " ")


def canonical_number(literal: Column) -> Column:
    """Without ordinal ending, with a leading zero, without zeros at the end of decimals."""
    plain = ~literal.contains(".") & F.right(literal, F.lit(1)).between("0", "9")
    bare = F.regexp_replace(literal, "(?i)(?:st|nd|rd|th)$", "")
    whole = F.when(bare.startswith("."), F.concat(F.lit("0"), bare)).otherwise(bare)
    return F.when(plain, literal).when(whole.contains("."), F.regexp_replace(F.regexp_replace(whole, "0+$", ""), r"\.$", "")).otherwise(whole)


def numbers_of(normal_text: Column, drop_citations: bool = True) -> Column:
    text = without_citations(normal_text) if drop_citations else normal_text
    return F.transform(F.regexp_extract_all(text, F.lit("(?i)" + NUMBER), F.lit(0)), canonical_number)


def numbers(text: Column, drop_citations: bool = True) -> Column:
    """Numeric literals as canonical strings, in order."""
    return numbers_of(normal(text), drop_citations)


def n_numbers(text: Column) -> Column:
    return F.when(text.rlike(r"\p{Nd}"), F.size(numbers(text))).otherwise(0)


def integer_soup_ratio(text: Column) -> Column:
    """The share of fields that are bare numbers; 0 without fields."""
    f = fields(text)
    return F.when(F.size(f) == 0, F.lit(0.0)).otherwise(F.size(F.filter(f, lambda x: x.rlike(BARE_NUMBER))) / F.size(f))


def is_integer_soup(text: Column, min_run: int = SOUP_FIELDS, ratio: float = SOUP_RATIO) -> Column:
    """Whether a run of text is tick labels and the like rather than prose.

    Where over two thirds of six fields or more are numbers, two stand side by side: without such a pair no field is looked at.
    """
    bare = F.filter(fields(text), lambda x: x.rlike(BARE_NUMBER))
    commonest = F.coalesce(F.array_max(F.transform(F.array_distinct(bare), lambda v: F.size(F.filter(bare, lambda x: x == v)))), F.lit(0))
    soup = (F.size(fields(text)) >= min_run) & (integer_soup_ratio(text) >= ratio) & ~text.rlike(rf"[.!?;:][{WHITE}]") & ((F.size(bare) == 0) | (commonest / F.size(bare) <= SOUP_REPEAT))
    return F.when(~text.rlike(NUMBER_PAIR), F.lit(False)).otherwise(soup) if min_run >= 6 and ratio > 2 / 3 else soup


def is_letter_soup(text: Column, min_letters: int = LETTER_SOUP_LETTERS, max_distinct: int = LETTER_SOUP_DISTINCT) -> Column:
    """Whether a run of text repeats two or three letters rather than spelling words."""
    letters = F.regexp_replace(text, "[^a-zA-Z]", "")
    return (F.length(letters) >= min_letters) & (F.size(F.array_distinct(F.filter(F.split(F.lower(letters), ""), lambda x: x != ""))) <= max_distinct)


def mask(text: Column) -> Column:
    """The normal form with digit runs as #."""
    return F.regexp_replace(normal(text), r"(?U)\d+", "#")


def html_text(html: Column) -> Column:
    """Text outside tags, collapsed."""
    return collapsed(F.regexp_replace(html, "<[^>]+>", " "))


def hyphenated_forms(text: Column) -> Column:
    """The distinct hyphenated words within lines, lower case, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(HYPHENATED), F.lit(0)), F.lower)))


def join_hyphenated(left: Column, right: Column, known: Column) -> Column:
    """Two neighbouring lines as one: at a hyphen that is no part of a known form, its two halves are one word."""
    stem = F.substring(left, F.lit(1), F.length(left) - 1)
    head = F.lower(F.element_at(F.split(stem, rf"[{WHITE}]"), -1))
    tail = F.lower(F.regexp_replace(F.element_at(F.split(right, rf"[{WHITE}]"), 1), r"^[.,;:)]+|[.,;:)]+$", ""))
    return (
        F.when(left.rlike(r"(?U)\d\u2013\z") & right.rlike(r"(?U)^\d"), F.concat(left, right))
        .when(~left.endswith("-"), F.concat(left, F.lit(" "), right))
        .when(F.array_contains(known, F.concat(head, F.lit("-"), tail)), F.concat(left, right))
        .otherwise(F.concat(stem, right))
    )


def joined_lines(lines: Column, known: Column) -> Column:
    """An array of lines as one text, joined two at a time from the front."""
    rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.when(F.size(lines) == 0, F.lit("")).otherwise(F.aggregate(rest, F.element_at(lines, 1), lambda a, x: join_hyphenated(a, x, known)))


def repair_decimals(text: Column) -> Column:
    """". 8" behind a blank or bracket as ".8"."""
    return F.regexp_replace(text, rf"(?<=[{WHITE}(])\.[{WHITE}]+(?=\d)", ".")


def clean_contents_line(text: Column) -> Column:
    """Without control characters, trimmed."""
    return strip(F.regexp_replace(text, r"[\x00-\x08\x0B-\x1F\x7F]", ""))


def slug(text: Column) -> Column:
    """Lower-case letters, digits and hyphens, with hyphens for blanks."""
    return F.array_join(fields(F.regexp_replace(F.lower(text), rf"[^a-z0-9{WHITE}-]", "")), "-")


def part_slug(number: Column, title: Column) -> Column:
    return F.concat(F.lit("part"), number.cast("string"), F.lit("-"), slug(title))


def chapter_id(number: Column) -> Column:
    return F.format_string("ch%02d", number.cast("int"))


def printed_page(number: Column, chapter: Column) -> Column:
    """Front matter, chapter 0, counts its first ten pages in Roman numerals."""
    roman = F.array(*map(F.lit, ROMAN))
    return F.when((chapter == 0) & number.between(1, len(ROMAN)), F.element_at(roman, F.greatest(number, F.lit(1)).cast("int"))).otherwise(number.cast("string"))


def title_from_file(name: Column) -> Column:
    return F.initcap(F.trim(F.regexp_replace(F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"\.[^.]*$", ""), "[-_]+", " ")))


def display_title(number: Column, title: Column) -> Column:
    return F.when(number == 0, title).otherwise(F.concat(number.cast("string"), F.lit(". "), title))


def alt_text(caption: Column, limit: int = ALT_LIMIT) -> Column:
    """A caption as an image's alternative text: no citations or brackets, tight punctuation, of bounded length."""
    out = F.regexp_replace(F.regexp_replace(caption, CITATION, ""), r"[\[\]]", "")
    out = collapsed(F.regexp_replace(out, rf"[{WHITE}]+([.,;:])", "$1"))
    out = F.when(F.length(out) > limit, F.concat(F.rtrim(F.substring(out, 1, limit - 1)), F.lit("\u2026"))).otherwise(out)
    return F.when(F.coalesce(caption, F.lit("")) == "", F.lit(NO_CAPTION)).otherwise(out)


def canonical_payoff(cell: Column) -> Column:
    """A payoff cell with ASCII minus signs, no plus signs, leading zeros and one way of separating parts."""
    plain = F.translate(cell, "\u2212\u2013", "--")
    part = lambda x: F.regexp_replace(F.regexp_replace(strip(x), r"^\++", ""), r"^(-?)\.", "$10.")
    return F.array_join(F.transform(F.split(plain, ","), part), ", ")


def clean_cell(text: Column) -> Column:
    """Collapsed, pipes escaped."""
    return F.replace(collapsed(text), F.lit("|"), F.lit("\\|"))


def label_key(label: Column) -> Column:
    """A dotted label as an array of numbers, which sorts as the label should; 0 for what is no number."""
    parts = F.transform(F.split(label, r"\."), lambda x: x.try_cast("int"))
    return F.when(F.exists(parts, lambda x: x.isNull()), F.array(F.lit(0))).otherwise(parts)


def target_chapter(label: Column) -> Column:
    """The chapter that a reference such as "Section 14.10" points into; exercises are numbered within theirs."""
    return F.nullif(F.regexp_extract(label, rf"^(?:Chapter|Section|Figure|Table|Equation)[{WHITE}]+\(?(\d+)", 1), F.lit("")).cast("int")


def target_anchor(kind: Column, number: Column) -> Column:
    """The name of the place that a kind of reference and its dotted number point to."""
    prefix = F.create_map(*(F.lit(x) for x in ("section", "sec-", "figure", "fig-", "table", "tbl-", "equation", "eq-")))
    dashed = F.replace(number, F.lit("."), F.lit("-"))
    return F.when(F.lower(kind) == "chapter", F.concat(F.lit("chapter-"), number)).otherwise(F.concat(F.coalesce(F.try_element_at(prefix, F.lower(kind)), F.lit("ex-")), dashed))


def malformed_latex(latex: Column) -> Column:
    """Braces that don't balance, or an environment that begins and never ends."""
    braces = lambda s: F.length(F.regexp_replace(latex, f"[^{s}]", ""))
    return (braces("{") != braces("}")) | (latex.contains("\\begin{") & ~latex.contains("\\end{"))


def textual_equation(text: Column, label: Column) -> Column:
    """Words that stand as an equation, with their label."""
    return F.concat(F.lit("\\text{"), collapsed(text), F.lit("}"), F.when(label.isNotNull(), F.concat(F.lit("\\tag{"), label, F.lit("}"))).otherwise(F.lit("")))


def equation_label(latex: Column) -> Column:
    """The label (n.m) at an equation's end."""
    return F.nullif(F.regexp_extract(latex, r"(?:\\quad\s*)?\((\d+\.\d+)\)\s*$", 1), F.lit(""))


def tagged_equation(latex: Column) -> Column:
    """An equation with its label as a tag."""
    label = equation_label(latex)
    body = F.rtrim(F.regexp_replace(latex, r"\s*(?:\\quad\s*)?\(\d+\.\d+\)\s*$", ""))
    return F.when(label.isNotNull(), F.concat(body, F.lit(" \\tag{"), label, F.lit("}"))).otherwise(latex)


def is_payoff(text: Column) -> Column:
    """Two or three numbers, symbols or maxima between commas, but not what is left of a number such as 200, 000."""
    whole = strip(text)
    padded = F.exists(F.split(whole, ","), lambda x: strip(x).rlike(rf"^{SIGN}0{{2,}}$"))
    return whole.rlike(rf"^{PAYOFF_PART}(?:\s*,\s*{PAYOFF_PART}){{1,2}}$") & ~padded


def is_bare_decimal(text: Column) -> Column:
    return strip(text).rlike(rf"^\(?{SIGN}(?:\d+\.\d+|\.\d+)\)?$")


def has_face(fonts: Column, hints: tuple[str, ...]) -> Column:
    """Whether a font's name holds one of the hints."""
    return F.exists(fonts, lambda f: F.exists(F.array(*map(F.lit, hints)), lambda h: f.contains(h)))


def is_math(fonts: Column) -> Column:
    return has_face(fonts, MATH_FACES)


def is_italic(fonts: Column) -> Column:
    return has_face(fonts, ITALIC_FACES)


def is_small_caps(font: Column) -> Column:
    return F.exists(F.array(*map(F.lit, SMALL_CAPS_FACES)), lambda h: font.contains(h))


def is_header_like(text: Column, fonts: Column, limit: int = HEADER_LETTERS) -> Column:
    """Italic, or as short as a name."""
    return is_italic(fonts) | (F.length(strip(text)) <= limit)


def is_data_row(text: Column) -> Column:
    """More than three numbers on a line."""
    return F.size(numbers(text)) > 3


def display_heading_size(body: Column) -> Column:
    return F.greatest(body * 2.2, F.lit(20.0))


def is_chapter_opener(size: Column, body: Column) -> Column:
    return size > body + 8.0


def context(words: Column, at: Column, around: int = 3) -> Column:
    """The words about a 0-based place, as one string."""
    first = F.greatest(at - around, F.lit(0))
    return F.array_join(F.slice(words, (first + 1).cast("int"), (at + around + 1 - first).cast("int")), " ")


def small_caps_spans(text: Column, words: Column) -> Column:
    """Whole words marked as small capitals, the longest first, unless they are marked already."""
    bare = F.array_distinct(F.transform(words, lambda w: F.regexp_replace(w, r"^[.,;:()\[\]]+|[.,;:()\[\]]+$", "")))
    longest = F.array_sort(F.filter(bare, lambda w: F.length(w) >= 2), lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    mark = lambda t, w: F.regexp_replace(t, F.concat(F.lit(r"(?U)(?<![\w>])\Q"), w, F.lit(r"\E(?![\w<])")), F.concat(F.lit('<span class="node">'), w, F.lit("</span>")))
    return F.aggregate(longest, text, mark)


def _indel(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    if not a and not b:
        return 100.0
    # Longest common subsequence by bit-parallel rows, one bit for each character of b.
    places: dict[str, int] = {}
    for i, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(b)) - 1
    free = full
    for c in a:
        hit = free & places.get(c, 0)
        free = ((free + hit) | (free - hit)) & full
    return 200.0 * (len(b) - free.bit_count()) / (len(a) + len(b))


@F.pandas_udf(T.DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 times the share of characters that no insertion or deletion between two strings touches."""
    return pd.Series([_indel(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
