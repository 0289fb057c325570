"""URL filter by a tree of path templates.

Rules (host, path) judge the urls they fit, the longest first. For the others a tree of path
templates is grown per host: a path's segments become the branches; segments that are variable by
their form (numbers, dates, hexadecimal names, uuids), or because a place has many values with few
urls each, become wildcards; then branches of a place that have the same shape below and whose
labelled urls are statistically alike (two-proportion z-test against the pooled share) are merged
into a wildcard. The labels are what the rules say, block or allow. A template is rejected if the
share of blocked among its labelled urls, smoothed toward the share among all labelled urls, reaches
`least_purity`; branches without labels are merged only with such ones, and a template without a
labelled url is allowed whatever its smoothed share, so nothing is blocked without labelled evidence
of its own template.

All steps after the first work on counts per (host, template), pre-aggregated in each task, so a
host with a third of all urls is a few rows. Segments below `MOST_DEPTH` become one `**`: they
are judged with their template like all others.

Defined results: a null url, or one without `://`, has an empty host and path, no rule and its own
template; repeated rows count as often as they occur and give repeated results; an empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored

#: (rule, verdict); a rule is host/path, its path the rest from the first slash on. Checked to be few, as they become literals.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
MOST_RULES = 1000

MOST_DEPTH = 8
#: A place is variable from so many values on, if they have fewer urls each on average.
MANY_VALUES, FEW_URLS = 20, 5
#: z from which two shares differ; weight of the common share in smoothing; share from which a template is rejected.
DIFFERENT, SMOOTHING, LEAST_PURITY = 1.96, 5.0, 0.9

# Forms of variable segments.
VARIABLE = (
    r"[0-9]+([-_.][0-9]+)*",
    r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"[0-9a-f]*[0-9][0-9a-f]{7,}",
)
FORM = f"(?i)^({'|'.join(VARIABLE)})(\\.[a-z]{{1,5}})?$"


def host_of(url: Column) -> Column:
    """From the first :// to the next / ? # or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, as a struct rule, verdict; null if none does."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    # Shortest first, so that the longest stands outermost; of equally long ones the first in order.
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        own_host, _, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + own_path)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def segments_of(path: Column) -> Column:
    """The segments, variable ones as *, with the ending of a file name; ** for all below MOST_DEPTH."""
    parts = F.filter(F.split(path, "/", -1), lambda s: s != "")
    shaped = F.transform(parts, lambda s: F.when(s.rlike(FORM), F.concat(F.lit("*"), F.regexp_extract(s, r"(\.[A-Za-z]{1,5})?$", 0))).otherwise(s))
    return F.when(F.size(shaped) <= MOST_DEPTH, shaped).otherwise(F.concat(F.slice(shaped, 1, MOST_DEPTH), F.array(F.lit("**"))))


def _put(segments: str, at: int, value) -> Column:
    """segments with the one at place `at` (from 0) replaced."""
    return F.transform(segments, lambda s, i: F.when(i == at, value).otherwise(s))


def _generalise(tree: DataFrame, at: int) -> DataFrame:
    """Place `at` becomes a wildcard below each (host, segments before) that has many values with few urls each."""
    before = tree.withColumns({"before": F.slice("now", 1, at), "value": F.get("now", F.lit(at))})
    values = before.where("value IS NOT NULL AND NOT startswith(value, '*')").groupBy("host", "before", "value").agg(F.sum("n").alias("n"))
    wide = values.groupBy("host", "before").agg(F.count("*").alias("values"), F.sum("n").alias("urls"))
    wide = wide.where((F.col("values") >= MANY_VALUES) & (F.col("urls") < FEW_URLS * F.col("values"))).select("host", "before", F.lit(True).alias("wide"))
    change = F.coalesce("wide", F.lit(False)) & F.col("value").isNotNull() & ~F.col("value").startswith("*")
    return before.join(wide, ["host", "before"], "left").withColumn("now", F.when(change, _put("now", at, F.lit("*"))).otherwise(F.col("now"))).select(*tree.columns)


def _merge(tree: DataFrame, at: int) -> DataFrame:
    """Branches at place `at` that differ in nothing else, and whose labels are alike, become one wildcard branch."""
    held = tree.withColumns({"value": F.get("now", F.lit(at)), "rest": _put("now", at, F.lit("*"))})
    branch = held.where("value IS NOT NULL AND NOT startswith(value, '*')").groupBy("host", "rest", "value").agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l"))
    labelled = F.col("l") > 0
    pool = branch.groupBy("host", "rest", labelled.alias("has")).agg(F.sum("b").alias("pb"), F.sum("l").alias("pl"), F.count("*").alias("branches"))
    both = branch.withColumn("has", labelled).join(pool, ["host", "rest", "has"])
    share = F.col("pb") / F.greatest("pl", F.lit(1))
    error = F.sqrt(share * (1 - share) / F.greatest("l", F.lit(1)))
    alike = ~F.col("has") | (F.abs(F.col("b") / F.greatest("l", F.lit(1)) - share) <= DIFFERENT * error + 1e-12)
    same = both.where((F.col("branches") > 1) & alike).groupBy("host", "rest", "has").agg(F.count("*").alias("n_alike")).where("n_alike > 1")
    merged = both.where(alike).join(same, ["host", "rest", "has"]).select("host", "rest", "value", F.lit(True).alias("merged"), "has")
    name = F.when(F.col("has"), F.lit("*")).otherwise(F.lit("*?"))
    return held.join(merged, ["host", "rest", "value"], "left").withColumn("now", F.when(F.coalesce("merged", F.lit(False)), _put("now", at, name)).otherwise(F.col("now"))).select(*tree.columns)


def judge(pages: DataFrame, rules=RULES, least_purity: float = LEAST_PURITY) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for every row of pages (page_id, url)."""
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.select("*", best_rule(F.col("host"), F.col("path"), rules).alias("fit"), segments_of(F.col("path")).alias("leaf"))
    counts = rows.groupBy("host", "leaf").agg(F.count("*").alias("n"), F.count_if(F.col("fit.verdict") == "block").alias("blocked"), F.count("fit.verdict").alias("labelled"))
    tree = stored(counts.withColumn("now", F.col("leaf")), "tree")
    depth = tree.agg(F.max(F.size("leaf")).alias("n")).first()["n"] or 0
    for at in range(depth):
        tree = stored(_generalise(tree, at), "tree")
    for at in range(depth):
        tree = stored(_merge(tree, at), "tree")
    told = tree.agg(F.coalesce(F.try_divide(F.sum("blocked"), F.sum("labelled")), F.lit(0.0)).alias("share")).first()["share"]
    purity = (F.sum("blocked") + F.lit(SMOOTHING * told)) / (F.sum("labelled") + F.lit(SMOOTHING))
    judged = tree.groupBy("host", "now").agg(purity.alias("purity"), (F.sum("labelled") > 0).alias("told"))
    templates = tree.select("host", "leaf", "now").join(judged, ["host", "now"]).select("host", "leaf", F.concat(F.lit("/"), F.array_join("now", "/")).alias("template"), "purity", "told")
    method = F.when(F.col("told") & (F.col("purity") >= least_purity), "block").otherwise("allow")
    return rows.join(templates, ["host", "leaf"]).select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", method).alias("verdict"), "template", "purity")
