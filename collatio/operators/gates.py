"""Gates: checks with a status for each chapter, and what follows from the statuses.

A gate returns keys, gate, status, hard and a detail as JSON. A missing input makes it BLOCKED, never absent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collatio.operators import multiset

# Fixed values.
COVERAGE, MIN_PIXELS, MIN_EQUATION, SAMPLE = 0.999, 100, 3, 40
GATES = ("text_coverage", "numeric_fidelity", "structural_counts", "assets", "math", "xrefs", "build", "visual")
SOFT = ("visual",)
PASSING = ("PASS", "REVIEWED")


def _gate(df: DataFrame, keys: Sequence[str], name: str, status: Column, detail: Column) -> DataFrame:
    return df.select(*keys, F.lit(name).alias("gate"), status.alias("status"), F.lit(name not in SOFT).alias("hard"), F.to_json(detail).alias("detail"))


def text_coverage(reference: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of token bags: PASS if the unrounded recall is COVERAGE or more; BLOCKED without reference tokens."""
    r = multiset.recall(multiset.difference(reference, candidate, keys), keys)
    status = F.when(F.col("recall").isNull(), "BLOCKED").when(F.col("recall") >= COVERAGE, "PASS").otherwise("FAIL")
    return _gate(r, keys, "text_coverage", status, F.struct("total", "missing", F.round("recall", 6).alias("recall")))


def numeric_fidelity(reference: DataFrame, candidate: DataFrame, keys: Sequence[str], item: str = "token") -> DataFrame:
    """Of number bags: PASS if nothing is missing and nothing extra."""
    r = multiset.recall(multiset.difference(reference, candidate, keys, item), keys)
    return _gate(r, keys, "numeric_fidelity", F.when((F.col("missing") == 0) & (F.col("extra") == 0), "PASS").otherwise("FAIL"), F.struct("total", "missing", "extra"))


def structural_counts(expected: DataFrame, got: DataFrame, keys: Sequence[str], sets: Sequence[str] = ("figures", "tables", "sections", "equations"), counts: Sequence[str] = ("exercises", "footnotes")) -> DataFrame:
    """Label sets and counts of both sides are equal; a count that neither side has isn't compared."""
    both = expected.alias("e").join(got.alias("g"), list(keys), "full")
    none = F.array().cast("array<string>")
    side = lambda s, c: F.coalesce(F.array_sort(F.array_distinct(F.col(f"{s}.{c}"))), none)
    same = F.lit(True)
    detail = []
    for c in sets:
        same = same & (side("e", c) == side("g", c))
        detail += [F.array_except(side("e", c), side("g", c)).alias(f"missing_{c}"), F.array_except(side("g", c), side("e", c)).alias(f"extra_{c}")]
    for c in counts:
        same = same & F.col(f"e.{c}").eqNullSafe(F.col(f"g.{c}"))
        detail += [F.col(f"e.{c}").alias(f"expected_{c}"), F.col(f"g.{c}").alias(f"got_{c}")]
    return _gate(both, keys, "structural_counts", F.when(same, "PASS").otherwise("FAIL"), F.struct(*detail))


def payoff_cells(expected: DataFrame, got: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Canonical cells (cell) of both sides as bags."""
    from collatio.functions.kernel import canonical_payoff

    bags = [multiset.bag(d, F.array(canonical_payoff(F.col("cell"))), keys, "cell") for d in (expected, got)]
    r = multiset.recall(multiset.difference(*bags, keys, "cell"), keys)
    return _gate(r, keys, "payoff_cells", F.when((F.col("missing") == 0) & (F.col("extra") == 0), "PASS").otherwise("FAIL"), F.struct("total", "missing", "extra"))


def asset_problems(assets: DataFrame, referenced: DataFrame, keys: Sequence[str], by_kind: bool = False) -> DataFrame:
    """keys, label and issue of assets (label, issue, file, length, width, height, alt, sha256, n) and of labels without one.

    length is null where the file is missing. With by_kind, a label is there only if one of its kind is.
    """
    from pyspark.sql import Window

    fine = F.col("issue").isNull()
    here = fine & F.col("file").isNotNull() & F.col("length").isNotNull()
    full = here & (F.col("length") > 0)
    w = Window.partitionBy(*keys, "sha256").orderBy("n")
    known = assets.withColumn("__again", full & F.col("sha256").isNotNull() & (F.row_number().over(w.orderBy(F.when(full, 0).otherwise(1), "n")) > 1))
    issues = F.array(
        F.when(~fine, F.col("issue")),
        F.when(fine & ~here, F.lit("file_missing")),
        F.when(here & (F.col("length") == 0), F.lit("zero_bytes")),
        F.when(full & (F.least(F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0))) < MIN_PIXELS), F.lit("too_small")),
        F.when(full & (F.trim(F.coalesce("alt", F.lit(""))) == ""), F.lit("empty_alt")),
        F.when(F.col("__again"), F.lit("duplicate_image")),
    )
    found = known.select(*keys, "label", F.explode(F.filter(issues, lambda x: x.isNotNull())).alias("issue"))
    on = [*keys, *(["kind"] if by_kind else []), "label"]
    absent = multiset.only_left(referenced, assets, on).select(*keys, "label", F.lit("referenced_but_absent").alias("issue"))
    return found.unionByName(absent)


def assets(chapters: DataFrame, problems: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PASS for chapters without a problem."""
    n = problems.groupBy(*keys).agg(F.count("*").alias("n"))
    return _gate(chapters.join(n, list(keys), "left"), keys, "assets", F.when(F.coalesce("n", F.lit(0)) == 0, "PASS").otherwise("FAIL"), F.struct(F.coalesce("n", F.lit(0)).alias("problems")))


def math(chapters: DataFrame, equations: DataFrame, keys: Sequence[str], checked: bool = False) -> DataFrame:
    """Equations (latex, error) are long enough and, where a checker ran, without errors; BLOCKED if it didn't."""
    from collatio.functions.kernel import malformed_latex

    bad = (F.length(F.trim("latex")) < MIN_EQUATION) | malformed_latex(F.col("latex")) | F.col("error").isNotNull()
    n = equations.groupBy(*keys).agg(F.count("*").alias("equations"), F.count_if(bad).alias("errors"))
    status = F.when(F.col("equations").isNull(), "PASS").when(F.col("errors") > 0, "FAIL").when(F.lit(checked), "PASS").otherwise("BLOCKED")
    return _gate(chapters.join(n, list(keys), "left"), keys, "math", status, F.struct("equations", "errors"))


def broken_links(links: DataFrame, site: DataFrame) -> DataFrame:
    """Links (route, anchor) to routes or anchors that the site index (route, anchor) hasn't; a null anchor needs the route alone."""
    slashless = F.regexp_replace("route", "/+$", "")
    links = links.withColumn("route", F.when(slashless == "", F.lit("/")).otherwise(slashless))
    targets = site.select("route", F.lit(None).cast("string").alias("anchor")).unionByName(site.where("anchor is not null").select("route", "anchor")).distinct()
    t = targets.select(F.col("route").alias("__r"), F.col("anchor").alias("__a"))
    return links.join(t, (F.col("route") == F.col("__r")) & F.col("anchor").eqNullSafe(F.col("__a")), "left_anti")


def xrefs(chapters: DataFrame, links: DataFrame, site: DataFrame, deferred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No broken link, and no reference left unlinked (label) whose chapter is among the emitted ones."""
    from collatio.functions.kernel import target_chapter

    broken = broken_links(links, site).groupBy(*keys).agg(F.count("*").alias("broken"))
    emitted = chapters.select(F.col("chapter").alias("__c")).distinct()
    wrong = deferred.withColumn("__t", target_chapter(F.col("label"))).join(emitted, F.col("__t") == F.col("__c"), "left_semi").groupBy(*keys).agg(F.count("*").alias("wrongly_deferred"))
    both = chapters.join(broken, list(keys), "left").join(wrong, list(keys), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return _gate(both, keys, "xrefs", F.when((zero("broken") == 0) & (zero("wrongly_deferred") == 0), "PASS").otherwise("FAIL"), F.struct(zero("broken"), zero("wrongly_deferred")))


def build(logs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of build logs (requested, exit_code, output): PASS at exit 0 without a warning; BLOCKED if none was asked for."""
    warned = F.exists(F.split(F.coalesce("output", F.lit("")), "\n"), lambda x: x.rlike(r"(?i)\bwarn(ing)?\b"))
    status = F.when(~F.col("requested"), "BLOCKED").when((F.col("exit_code") == 0) & ~warned, "PASS").otherwise("FAIL")
    return _gate(logs, keys, "build", status, F.struct("exit_code", warned.alias("warnings")))


def visual(flagged: DataFrame, checked: DataFrame, chapters: DataFrame, keys: Sequence[str], page: str = "page") -> DataFrame:
    """REVIEWED if every flagged page has been checked."""
    left = multiset.only_left(flagged, checked, [*keys, page]).groupBy(*keys).agg(F.count("*").alias("outstanding"))
    n = F.coalesce("outstanding", F.lit(0))
    return _gate(chapters.join(left, list(keys), "left"), keys, "visual", F.when(n == 0, "REVIEWED").otherwise("FAIL"), F.struct(n.alias("outstanding")))


def review_queue(removed: DataFrame, results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, kind and what: soup that was removed (page, reason, text), failed gates and blocked ones."""
    soup = removed.where("reason = 'integer_soup'").select(*keys, F.col("reason").alias("kind"), F.substring("text", 1, 160).alias("what"))
    kind = F.when(F.col("status") == "FAIL", "gate_failure").when(F.col("status") == "BLOCKED", "gate_blocked")
    return soup.unionByName(results.withColumn("kind", kind).where("kind is not null").select(*keys, "kind", F.col("gate").alias("what")))


def chapter_status(results: DataFrame, queue: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and status: FAIL or BLOCKED by hard gates, else REVIEW if anything waits for review, else PASS."""
    r = results.groupBy(*keys).agg(F.bool_or(F.col("hard") & (F.col("status") == "FAIL")).alias("f"), F.bool_or(F.col("hard") & (F.col("status") == "BLOCKED")).alias("b"))
    q = queue.groupBy(*keys).agg(F.count("*").alias("n"))
    return r.join(q, list(keys), "left").select(*keys, F.when(F.col("f"), "FAIL").when(F.col("b"), "BLOCKED").when(F.coalesce("n", F.lit(0)) > 0, "REVIEW").otherwise("PASS").alias("status"))


def progress(chapters: DataFrame, results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, gates_passed and status of chapters (started): green if all GATES pass, failing if any fails."""
    passing = F.count_if(F.col("gate").isin(*GATES) & F.col("status").isin(*PASSING))
    r = results.groupBy(*keys).agg(passing.alias("passed"), F.bool_or(F.col("status") == "FAIL").alias("f"))
    status = F.when(F.col("passed") == len(GATES), "green").when(F.col("f"), "failing").when(F.col("passed").isNotNull() | F.col("started"), "in progress").otherwise("not started")
    return chapters.join(r, list(keys), "left").select(*keys, F.coalesce("passed", F.lit(0)).alias("gates_passed"), status.alias("status"))


def details(found: DataFrame, keys: Sequence[str], order: str, most: int) -> DataFrame:
    """The first rows of each key, with their place: what a gate's report lists beside its counts."""
    w = Window.partitionBy(*keys).orderBy(order)
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)
