"""Surrogates for personal data: detected entities are replaced by keyed ones of the same type and shape.

Digits become digits, and letters become letters of the same script and case: vowels vowels and consonants
consonants in Latin and Cyrillic, letters of the same kind in all other scripts, ideographs ideographs.
Separators stay. Of an e-mail address the top-level domain stays, of a phone number its country code, of an
account number its country, of a name its title. Common first and last names become others of the same list,
so of the same script and gender; other names are moved letter by letter, never onto a listed one. Addresses
of networks stay valid ones; valid card and account numbers stay valid by Luhn's rule and modulo 97, invalid
ones invalid. A character's replacement depends on the key, the type and all characters before it (then, in a
second pass, behind it), which makes the mapping one to one: two entities of a type never share a surrogate,
and an entity, or the same last name in two names, has the same one in all documents, however it is spaced or
cased. `collisions` checks this on a corpus.

The mapping can be undone by whoever has the key, so it has no default; `session_key` reads it from the
configuration. Only DataFrame functions run; a text is searched once. Null texts stay null; texts without
entities, also empty ones, stay as they are; long ones are searched whole. Rows are independent, so repeated
rows and other columns are kept as they come; a column named like the results is replaced. An empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import secrets
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The setting that holds the key.
KEY = "spark.collatio.pii.key"

#: Countries whose account numbers hold letters or may do so, by the length of the whole number.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(f"(?:{c.replace(' ', '|')})\\d{{2}}(?=[ 0-9]*[A-Z])(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in _IBAN_LENGTHS.items())

#: Titles, and common names by script and gender, each in one list alone.
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra|Г-н|Г-жа"
FIRST_NAMES = (
    "Anna Maria Laura Julia Sofia Emma Clara Elena Marta Alice Louise Camille Ines Carla Nora Helen Sarah Emily Paula Ursula Monika Petra Heike Claire Sophie Juliette Carmen Isabel",
    "Peter Thomas Michael David Daniel Robert James George Edward Henry Hans Klaus Jürgen Stefan Wolfgang Pierre Jacques Antoine Philippe François Carlos Miguel Javier Antonio Fernando Pablo Diego",
    "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана Екатерина Людмила", "Иван Сергей Андрей Алексей Дмитрий Николай Владимир Михаил Борис Павел",
    "Μαρία Ελένη Κατερίνα Σοφία Δήμητρα Ιωάννα", "Γιώργος Δημήτρης Κώστας Νίκος Γιάννης Λάμπρος",
)
LAST_NAMES = (
    "Smith Jones Taylor Johnson Williams Wilson Müller Schmidt Schneider Fischer Weber Becker Hoffmann Martin Bernard Dubois Moreau Laurent Lefebvre García Garcia López Lopez Martínez Martinez Hernández Sánchez Fernández",
    "Иванова Смирнова Кузнецова Попова Соколова Лебедева", "Иванов Смирнов Кузнецов Попов Соколов Лебедев", "Παππά Νικολάου Γεωργίου Δημητρίου", "Παππάς Παπαδόπουλος Αντωνίου Βασιλείου",
)
WORD = r"(?:\p{Lu}[\p{Ll}\p{M}]+(?:-\p{Lu}[\p{Ll}\p{M}]+)?|\p{Lo}[\p{Lo}\p{M}]{1,11})"
_FIRST = "|".join(n for names in FIRST_NAMES for n in names.split())

#: Type and pattern, in the order in which they are tried at a place.
TYPES: tuple[tuple[str, str], ...] = (
    ("email", r"[\p{L}\p{M}\p{N}._%+\-]{1,64}@[\p{L}\p{M}\p{N}\-]{1,63}(?:\.[\p{L}\p{M}\p{N}\-]{1,63}){0,6}\.\p{L}[\p{L}\p{M}]{1,23}"),
    ("secret", r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\p{L}\p{N}])"),
    ("secret", r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,64})(?![\p{L}\p{N}])"),
    ("iban", r"(?<![\p{L}\p{N}])(?:" + _IBAN + r")(?![\p{L}\p{N}])"),
    ("iban", r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?\d{4}){3,7}(?: ?\d{1,3})?(?![\p{L}\p{N}])"),
    ("phone", r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}(?!\d)"),
    ("phone", r"(?<![\p{L}\p{N}])(?:\(\d{3}\) ?|\d{3}[.\-])\d{3}[.\-]\d{4}(?!\d)"),
    ("ssn", r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\d\-])"),
    ("card", r"(?<![\p{L}\p{N}])(?:\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{4}|\d{13,19})(?!\d)"),
    ("ip", r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"),
    ("name", r"(?<![\p{L}\p{N}])(?:" + TITLES + r")\.? " + WORD + "(?: " + WORD + ")?"),
    ("name", r"(?<![\p{L}\p{N}])(?=\p{Lu})(?:" + _FIRST + ") " + WORD + r"(?![\p{L}\p{N}])"),
)
NAMES = tuple(dict.fromkeys(name for name, _ in TYPES))
ANY = "(?:" + "|".join(p for _, p in TYPES) + ")"
#: Marks the ends of entities; texts that hold it already are searched twice instead.
MARK = "\u0001\u0003\u0002\u0001"
#: No entity is without one of these.
QUICK = r"[0-9@]|sk-|gh[pousr]_|AKIA|[a-f]{32}|[A-F]{32}|(?:" + TITLES + r")\.? [\p{Lu}\p{Lo}]|(?=\p{Lu})(?:" + _FIRST + r") [\p{Lu}\p{Lo}]"
#: Country codes of one and two digits; all others have three.
_COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

#: Characters that stand for one another.
ASCII_CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz")
HEX_CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz")
OTHER_CLASSES = ("àáâäèéêëìíîïòóôöùúûü", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ")
#: Runs of so many letters or more of one kind are moved by their number.
_RUN = 2000


@functools.cache
def _letters() -> tuple[str, str, list[int], list[int], list[tuple[int, int]]]:
    """All letters, marks and digits beyond ASCII by class, the class of each as a character, the classes' beginnings and sizes, and long runs."""
    own = {c: cls for cls in OTHER_CLASSES for c in cls}
    classes: dict[object, list[str]] = {cls: list(cls) for cls in OTHER_CLASSES}
    runs: list[list] = []
    for i in range(0x80, 0x110000):
        c = chr(i)
        category = unicodedata.category(c)
        if category[0] not in "LMN":
            continue
        script = unicodedata.name(c, "?").split()[0]
        if runs and runs[-1][1] == i - 1 and runs[-1][2] == (script, category):
            runs[-1][1] = i
        else:
            runs.append([i, i, (script, category)])
    for lo, hi, (script, category) in runs:
        if hi - lo + 1 >= _RUN:
            continue
        for c in map(chr, range(lo, hi + 1)):
            low, up = c.lower(), c.upper()
            if c in own or (low != c and len(low) == 1 and low.upper() == c):
                continue  # an upper-case letter stands for its lower-case one
            cased = len(up) == 1 and up != c and up.lower() == c
            classes.setdefault((script, cased, "L" if cased or category in ("Lo", "Lm") else category), []).append(c)
    members = [m for m in classes.values() if len(m) > 1]
    lone = [m[0] for m in classes.values() if len(m) == 1]
    members += [lone] if len(lone) > 1 else []
    begins = [1]
    for m in members:
        begins.append(begins[-1] + len(m))
    marks = "".join(chr(0x4E00 + k) * len(m) for k, m in enumerate(members))
    return "".join(c for m in members for c in m), marks, begins[:-1], [len(m) for m in members], [(lo, hi) for lo, hi, _ in runs if hi - lo + 1 >= _RUN]


def _named(value: Column, body) -> Column:
    """body(value), with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _beyond_ascii(x: Column, h: Column) -> Column:
    """A letter, mark or digit moved within its class by h; null if it is in none."""
    members, marks, begins, sizes, runs = _letters()
    begin, size = (F.expr(f"array({', '.join(map(str, v))})") for v in (begins, sizes))

    def listed(at: Column) -> Column:
        k = F.ascii(F.substring(F.lit(marks), at, F.lit(1))) - 0x4E00
        first, n = F.get(begin, k), F.get(size, k)
        return F.when(at > 0, F.substring(F.lit(members), (first + F.pmod(at - first + F.pmod(h, n), n)).cast("int"), F.lit(1)))

    code, out = F.ascii(x), F.lit(None).cast("string")
    for lo, hi in runs:
        new = F.lit(lo) + F.pmod(code - lo + F.pmod(h, F.lit(hi - lo + 1)), F.lit(hi - lo + 1))
        out = F.when(code.between(lo, hi), F.decode(F.unhex(F.lpad(F.hex(new), 8, "0")), "UTF-32")).otherwise(out)
    return F.coalesce(out, _named(F.instr(F.lit(members), x), listed))


def _pass(text: Column, key: Column, classes: list[Column]) -> Column:
    """Each character moved within its class by a hash of the key and the class characters before it."""

    def step(a: Column, c: Column) -> Column:
        low = F.lower(c)
        plain = F.when((F.length(low) == 1) & ((low == c) | (F.upper(low) == c)), low).otherwise(c)

        def moved(x: Column, h: Column) -> Column:
            new = F.when(x >= "\u0080", _beyond_ascii(x, h))
            for cls in classes:
                at, n = F.instr(cls, x), F.length(cls)
                new = F.when(at > 0, F.substring(cls, F.pmod(at - 1 + F.pmod(h, n), n).cast("int") + 1, F.lit(1))).otherwise(new)
            return new

        def after(v: Column) -> Column:
            shown = F.when(v["new"].isNull(), c).when(v["x"] == c, v["new"]).otherwise(F.upper(v["new"]))
            return F.struct(F.when(v["new"].isNull(), a["before"]).otherwise(F.concat(a["before"], v["x"])).alias("before"), F.concat(a["out"], shown).alias("out"))

        h = F.xxhash64(F.concat(key, F.lit("|"), a["before"]))
        return _named(plain, lambda x: _named(F.struct(x.alias("x"), moved(x, h).alias("new")), after))

    return F.aggregate(_characters(text), F.struct(F.lit("").alias("before"), F.lit("").alias("out")), step, lambda a: a["out"])


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _moved(text: Column, key: Column, hexadecimal: Column | None = None) -> Column:
    """Both passes over a text, in hexadecimal classes where that is true."""
    classes = [F.lit(a) if hexadecimal is None or a == b else F.when(hexadecimal, b).otherwise(a) for a, b in zip(ASCII_CLASSES, HEX_CLASSES, strict=True)]
    there = _pass(text, F.concat(key, F.lit(">")), classes)
    return F.reverse(_pass(F.reverse(there), F.concat(key, F.lit("<")), classes))


def _refilled(entity: Column, new: Column) -> Column:
    """The entity with its letters and digits replaced by the characters of `new` in turn."""
    step = lambda a, c: F.when(c.rlike(r"[\p{L}\p{N}]"), F.struct((a["i"] + 1).alias("i"), F.concat(a["out"], F.substring(new, a["i"], F.lit(1))).alias("out"))).otherwise(F.struct(a["i"].alias("i"), F.concat(a["out"], c).alias("out")))
    return F.aggregate(_characters(entity), F.struct(F.lit(1).alias("i"), F.lit("").alias("out")), step, lambda a: a["out"])


def _bare(entity: Column) -> Column:
    return F.regexp_replace(entity, r"[^\p{L}\p{N}]", "")


def luhn(digits: Column) -> Column:
    """The check digit of a row of digits."""

    def step(a: Column, c: Column) -> Column:
        d = c.cast("int") * F.when(a["odd"], 2).otherwise(1)
        return F.struct((a["sum"] + F.when(d > 9, d - 9).otherwise(d)).alias("sum"), (~a["odd"]).alias("odd"))

    return F.aggregate(_characters(F.reverse(digits)), F.struct(F.lit(0).alias("sum"), F.lit(True).alias("odd")), step, lambda a: F.pmod(-a["sum"], F.lit(10)))


def check_97(country: Column, rest: Column) -> Column:
    """The check digits, as a number, of an account number's country and all behind its check digits."""
    value = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda a, c: F.pmod(a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c), F.lit(97))
    return F.lit(98) - F.aggregate(_characters(F.upper(F.concat(rest, country, F.lit("00")))), F.lit(0), step)


def _turned(secret: str) -> dict[str, str]:
    """Each listed name's successor in its list, in an order that the key gives."""
    out = {}
    for names in (*FIRST_NAMES, *LAST_NAMES):
        turn = sorted(names.split(), key=lambda n: hmac.new(secret.encode(), n.encode(), hashlib.sha256).digest())
        out |= dict(zip(turn, turn[1:] + turn[:1], strict=True))
    return out


def _name(entity: Column, key: Column, secret: str) -> Column:
    listed = F.expr(f"map({', '.join(repr(x) for pair in _turned(secret).items() for x in pair)})")
    title = F.regexp_extract(entity, r"^(?:" + TITLES + r")\.? ", 0)

    def other(w: Column) -> Column:
        # A listed name is no surrogate of an unlisted one: it is moved on.
        return _named(_moved(w, key), lambda new: F.when(F.try_element_at(listed, new).isNotNull(), _moved(new, key)).otherwise(new))

    words = F.split(F.substring(entity, F.length(title) + 1, F.length(entity)), " ")
    return F.concat(title, F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(listed, w), other(w))), " "))


def _address(text: Column, key: Column) -> Column:
    """A permutation of the 32-bit addresses, in four Feistel rounds."""
    o = [F.split(text, r"\.")[i].cast("long") for i in range(4)]
    left, right = o[0] * 256 + o[1], o[2] * 256 + o[3]
    pair = F.struct(left.alias("l"), right.alias("r"))

    def round_(a: Column, i: Column) -> Column:
        h = F.pmod(F.xxhash64(F.concat_ws("|", key, i.cast("string"), a["r"].cast("string"))), F.lit(65536))
        return F.struct(a["r"].alias("l"), a["l"].bitwiseXOR(h).alias("r"))

    octets = lambda a: F.concat_ws(".", *(x.cast("string") for h in (a["l"], a["r"]) for x in (F.shiftright(h, 8), h.bitwiseAND(F.lit(255)))))
    return F.aggregate(F.array(*map(F.lit, range(4))), pair, round_, octets)


def entity_type(entity: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(TYPES):
        alone = pattern.replace(r"(?<![\p{L}\p{N}])", "").replace(r"(?<![\p{L}\p{N}.])", "").replace(r"(?<![\p{L}\p{N}\-])", "")
        out = F.when(entity.rlike(f"^(?:{alone})$"), name).otherwise(out)
    return out


def canonical(entity: Column, kind: Column) -> Column:
    """What an entity is, however it is written: of numbers their digits, else the lower case."""
    return F.when(kind.isin("phone", "ssn", "card", "iban"), F.regexp_replace(F.lower(entity), r"[^\p{L}\p{N}]", "")).otherwise(F.lower(entity))


def surrogate(entity: Column, kind: Column, secret: str) -> Column:
    """The replacement of an entity of a type."""
    key = F.concat(F.lit(secret + "|"), kind)
    bare = _bare(entity)
    first = F.when(kind == "phone", F.regexp_extract(entity, _COUNTRY, 0)).when(kind == "secret", F.regexp_extract(entity, "^(?:AKIA|gh[pousr]_|sk-)", 0)).otherwise("")
    last = F.when(kind == "email", F.regexp_extract(entity, r"\.[\p{L}\p{M}]+$", 0)).otherwise("")
    inner = F.substring(entity, F.length(first) + 1, F.length(entity) - F.length(first) - F.length(last))
    country, rest, digits = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, F.lit(1), F.length(bare) - 1)
    body = F.when(kind == "iban", rest).when(kind == "card", digits).otherwise(inner)
    own = F.when(kind == "iban", F.concat(key, country)).otherwise(key)

    def whole(new: Column) -> Column:
        # Check digits are as far from the right ones as they were.
        account = F.pmod(F.substring(bare, 3, 2).cast("int") - check_97(country, rest) + check_97(country, new), F.lit(100))
        last_digit = F.pmod(F.substring(bare, -1, 1).cast("int") - luhn(digits) + luhn(new), F.lit(10))
        number = F.when(kind == "iban", F.concat(country, F.lpad(account.cast("string"), 2, "0"), new)).otherwise(F.concat(new, last_digit.cast("string")))
        return F.when(kind.isin("iban", "card"), _refilled(entity, number)).otherwise(F.concat(first, new, last))

    return F.when(kind == "ip", _address(entity, key)).when(kind == "name", _name(entity, key, secret)).otherwise(_named(_moved(body, own, kind == "secret"), whole))


def _parts(text: Column) -> Column:
    """Text between entities and entities by turns, beginning and ending with text."""
    marked = F.split(F.regexp_replace(text, ANY, MARK.replace("\\", "\\\\") + "$0" + MARK), MARK, -1)
    gaps, found = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    twice = F.flatten(F.zip_with(gaps, found, lambda g, e: F.array(g, e)))
    twice = F.slice(twice, F.lit(1), 2 * F.size(found) + 1)
    return F.when(text.contains(MARK), twice).when(text.rlike(QUICK), marked).otherwise(F.array(text))


PAIR = "array<struct<type:string,entity:bigint,surrogate:bigint>>"


def replaced(docs: DataFrame, secret: str, text: str = "text", pairs: bool = False) -> DataFrame:
    """`docs` with surrogates in the text, and `entity_types`, the type of each entity in order.

    With `pairs` there is a column `entity_pairs`, too: type, entity and surrogate of each, the last two as hashes.
    """
    out = ("entity_types", *(("entity_pairs",) if pairs else ()))
    names = [c for c in docs.columns if c not in out]
    t = F.col(f"`{text}`")
    found = docs.select(*(F.col(f"`{c}`") for c in names), _parts(t).alias("__parts"))
    # Half of the parts are entities; type and surrogate are worked out for those alone.
    entity = lambda x: _named(entity_type(x), lambda k: F.struct(k.alias("type"), x.alias("old"), surrogate(x, k, secret).alias("new")))
    found = found.withColumn("__found", F.when(F.size("__parts") > 1, F.transform(F.filter("__parts", lambda x, i: i % 2 == 1), entity)))
    whole = F.concat(F.array_join(F.flatten(F.zip_with(F.filter("__parts", lambda x, i: i % 2 == 0), F.col("__found.new"), lambda g, e: F.array(g, F.coalesce(e, F.lit(""))))), ""))
    hashed = lambda v, c: F.xxhash64(canonical(v[c], v["type"]))
    made = {
        text: F.when(F.size("__parts") > 1, whole).otherwise(t),
        "entity_types": F.coalesce(F.col("__found.type"), F.array().cast("array<string>")),
        "entity_pairs": F.coalesce(F.transform("__found", lambda v: F.struct(v["type"].alias("type"), hashed(v, "old").alias("entity"), hashed(v, "new").alias("surrogate"))), F.array().cast(PAIR)),
    }
    return found.select(*(made.get(c, F.col(f"`{c}`")).alias(c) for c in (*names, *out)))


def entities(found: DataFrame) -> DataFrame:
    """The distinct (type, entity, surrogate) of what `replaced(..., pairs=True)` returns."""
    return found.select(F.explode("entity_pairs").alias("p")).select("p.*").distinct()


def collisions(found: DataFrame) -> DataFrame:
    """Of `entities`: surrogates that more than one entity of a type has, and entities with more than one."""
    shared = found.groupBy("type", F.col("surrogate").alias("value")).agg(F.count("*").alias("n")).where("n > 1").withColumn("what", F.lit("surrogate"))
    torn = found.groupBy("type", F.col("entity").alias("value")).agg(F.count("*").alias("n")).where("n > 1").withColumn("what", F.lit("entity"))
    return shared.unionByName(torn)


@functools.cache
def _own_key() -> str:
    return secrets.token_hex(32)


def session_key(spark: SparkSession) -> str:
    """The key that the session's configuration holds, or else one drawn for this process, which nobody can repeat."""
    return spark.conf.get(KEY, None) or _own_key()


def fitting(columns: list[str], text: str = "text") -> list[Column]:
    """The given columns of what `replaced` returns, with n_chars, if it is one, worked out again."""
    return [F.length(F.col(f"`{text}`")).cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns]
