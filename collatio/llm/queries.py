"""One thin query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.llm import langid, licenses, mixing, neardup, packing, pii, quality, substrings, topk, toxicity
from collatio.llm.sampling import held_out
from collatio.llm.staging import staged
from collatio.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document, and what policy v1 says of it."""
    book = quality.ledger(table(spark, sf_dir, "documents"))
    base = F.col("failed_bits").bitwiseAND(F.lit(quality.mask(quality.BASE))) != 0
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), quality.passes("v1").alias("kept"), "failed_bits",
    )


ORACLES["op10_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
x AS (SELECT r, unnest(list_transform(range(1, len(ws) - 6), lambda i: struct_pack(i := i, k := array_to_string(ws[i:i+7], ' ')))) AS u FROM w),
y AS (SELECT r, u.i AS i, count(*) OVER (PARTITION BY r, u.k) AS n FROM x),
z AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM y WHERE n > 1) GROUP BY r),
m AS (
  SELECT w.r, doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(regexp_extract_all(t, '\p{Lu}|\p{Lt}')) AS n_upper, len(regexp_extract_all(t, '\p{L}')) AS n_letters,
         len(regexp_extract_all(t, '[\x{0E00}-\x{0FFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3000}-\x{312F}\x{31A0}-\x{31BF}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{A4CF}\x{F900}-\x{FAFF}\x{FE30}-\x{FE4F}\x{FF00}-\x{FF9F}]')) AS n_unspaced
  FROM w LEFT JOIN z ON w.r = z.r),
b AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END) + (CASE WHEN 5 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN n_lines >= 5 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars - n_unspaced > 20 * n_words AND 2 * n_unspaced < word_chars THEN 32 ELSE 0 END) + (CASE WHEN 100 * n_upper > 60 * n_letters AND n_words >= 20 THEN 64 ELSE 0 END) AS failed_bits
  FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, failed_bits = 0 AS kept, CAST(failed_bits AS BIGINT) AS failed_bits
FROM b
"""

_LEDGER = ORACLES["op10_quality_rules"].strip()
ORACLES["quality_ablations"] = "WITH book AS (" + _LEDGER + "), r AS (SELECT unnest(['few_words', 'repeated_words', 'many_symbols', 'duplicate_lines', 'short_words', 'long_words', 'shouting']) AS rule, unnest([1, 2, 4, 8, 16, 32, 64]) AS bit) " + """
SELECT rule, CAST(count(*) FILTER (failed_bits & bit <> 0) AS BIGINT) AS n_failed, CAST(count(*) FILTER (failed_bits = bit) AS BIGINT) AS n_failed_alone, CAST(count(*) FILTER (failed_bits & ~bit = 0) AS BIGINT) AS n_kept_without
FROM book, r GROUP BY rule
"""


@query
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each rule of policy v1: documents that fail it, that fail it alone, and that the policy without it keeps."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents")), "v1")


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents at 150 % of their words."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "whole_epochs")


ORACLES["op1_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS UBIGINT) AS BIGINT) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM s),
c AS (SELECT *, CAST([5, 2, 1][CAST((sid - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight, CAST(source_size AS DOUBLE) * 2 AS cap FROM w),
l AS (SELECT *, cap / weight AS reach, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS budget,
        coalesce(sum(cap) OVER (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
        sum(weight) OVER (ORDER BY cap / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM c),
v AS (SELECT (budget - filled) / rest AS level FROM l WHERE reach > (budget - filled) / rest ORDER BY reach, sid LIMIT 1),
t AS (SELECT source, source_size, coalesce(least(cap, weight * (SELECT level FROM v)), cap) AS target FROM l),
p AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN CAST(floor(floor(t.target) / t.source_size) AS BIGINT) ELSE 0 END AS whole_epochs,
        CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) ELSE 0 END AS goal,
        coalesce(CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(whole_epochs * size + greatest(0, least(size, goal - whole_epochs * source_size - before)) AS BIGINT) AS taken, source, whole_epochs
FROM p
"""


@query
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows for each vector whose id is divisible by 50, of all others."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = topk.Index.build(vectors, scale=256.0).search(vectors.where(F.col("id") % 50 == 0), 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLES["op2_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.e, x.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles are similar by 0.85 or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that started before."""
    kept = substrings.without_repetitions(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where an installed public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 2048 ids."""
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = staged(pii.replaced(docs, pii.session_key(spark), pairs=True), "surrogates")
    # How many surrogates of the corpus are no one entity's, and entities torn: none, or the rows say so.
    wrong = pii.collisions(pii.entities(out)).count()
    return out.select("doc_id", F.size("entity_types").cast("long").alias("n_entities"), F.array_join(F.array_sort(F.array_distinct("entity_types")), ",").alias("types"), "text", F.lit(wrong).cast("long").alias("n_collisions"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document by its canonical digest, and those that its lines name."""
    found = licenses.scanned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text_digest", "text_license", F.array_join("notice_licenses", ",").alias("notice_licenses"))


def _canonical_sql(text: str) -> str:
    out = f"lower({text})"
    for pattern in (licenses.COPYRIGHT_LINE, licenses.TITLE_LINE, licenses.LIST_MARK):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    out = f"(' ' || regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' ')".replace("\\\\", "\\")
    for old, new in licenses.SPELLINGS:
        out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


ORACLES["op7_license_scan"] = f"""
WITH k AS (SELECT * FROM (VALUES {", ".join(f"('{d}', '{n}')" for d, n in licenses.CATALOGUE)}) AS t(d, name)),
c AS (SELECT doc_id, {_canonical_sql("text")} AS c FROM documents),
w AS (SELECT doc_id, CASE WHEN c <> '' THEN sha256(c) END AS text_digest FROM c),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
m AS (SELECT DISTINCT doc_id, name FROM (SELECT doc_id, sha256({_canonical_sql("line")}) AS d FROM l WHERE regexp_matches(lower(line), '{licenses.GATE}')) x JOIN k USING (d)),
n AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS names FROM m GROUP BY doc_id)
SELECT w.doc_id, w.text_digest, k.name AS text_license, coalesce(n.names, '') AS notice_licenses
FROM w LEFT JOIN k ON w.text_digest = k.d LEFT JOIN n ON w.doc_id = n.doc_id
"""


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document by a network learnt from the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    found = toxicity.scored(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by automata of the texts that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identified(docs, langid.trained(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
