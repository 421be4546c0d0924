"""URL filters: rules by host and path, and a path-template tree learned from labels.

The tree has a node per host and leading path segments. Segments that vary from page to
page (numbers, ids, long names) become wildcards; then, level by level and as deep as the
paths go, the branches of a node whose share of bad pages differs from their parent's no more than chance allows
are merged into one wildcard branch. A node's purity is its share of bad labels,
smoothed towards its parent's; a page is blocked if its template's purity reaches the
limit. Where a rule fits, the longest one decides instead.

Only Spark functions are used. Pages are first counted per host and generalised path,
with partial sums in every task, so the tree works on templates, not on pages. There is
one round per level; a path whose last segment has been placed takes no part in later ones, nor do
templates that cannot part any more: below one without labels purity stays what it is, and that of a
template with a single path follows from the number of segments left. So there are rounds
only as deep as a labelled template holds several paths.

Defined cases: a null url, or one without ``://``, has an empty host and path; no rule fits
it and it belongs to the empty template; unlabelled pages count as no evidence; of
several labels for one page each counts; repeated pages are judged each; extra columns are ignored; an empty
table gives an empty result, an empty label table the verdict ``allow``.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallykeep.llm.common import durable

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """A verdict for a host with all its subdomains, and paths with a given start."""

    verdict: str
    host: str
    path: str


RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)

# Labels' worth of the parent's purity that every node starts with.
SMOOTHING = 10.0
# Standard deviations within which a branch counts as similar to its parent.
SIMILAR = 1.96
BLOCK_PURITY = 0.5
# A longer segment is taken for a name of its own.
LONGEST_SEGMENT = 24

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def _first_fit(rules: tuple[Rule, ...], host: Column, path: Column, field) -> Column:
    """A field of the longest rule that fits, else null."""
    longest_first = sorted(rules, key=lambda rule: len(rule.host + rule.path), reverse=True)
    none = F.lit(None).cast("string")
    return reduce(
        lambda rest, rule: F.when(_fits(rule, host, path), F.lit(field(rule))).otherwise(rest),
        reversed(longest_first),
        none,
    )


def segments(path: Column) -> Column:
    """The segments of a path, variable ones as wildcards."""
    named = F.filter(F.split(path, "/"), lambda one: one != "")
    variable = lambda one: one.rlike("[0-9]") | (F.length(one) > LONGEST_SEGMENT) | one.contains("*")
    return F.transform(named, lambda one: F.when(variable(one), "*").otherwise(one))


def _grow(leaves: DataFrame, level: int) -> DataFrame:
    """Extend every template by one segment, similar branches merged, and smooth its purity."""
    at = leaves.withColumn("segment", F.coalesce(F.get("segments", F.lit(level)), F.lit("")))
    branches = at.groupBy("host", "template", "segment").agg(
        F.sum("labelled").alias("n"), F.sum("bad").alias("b"), F.max("purity").alias("above")
    )
    parents = branches.groupBy("host", "template").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
    share = F.when(F.col("all_n") > 0, F.col("all_b") / F.col("all_n")).otherwise(0.0)
    spread = SIMILAR * F.sqrt(F.col("n") * share * (1 - share))
    merged = F.when(
        (F.col("segment") != "") & (F.abs(F.col("b") - F.col("n") * share) <= spread), "*"
    ).otherwise(F.col("segment"))
    named = branches.join(parents, ["host", "template"]).withColumn("branch", merged)
    nodes = named.groupBy("host", "template", "branch").agg(
        ((F.sum("b") + SMOOTHING * F.max("above")) / (F.sum("n") + SMOOTHING)).alias("node_purity")
    )
    known = named.select("host", "template", "segment", "branch").join(nodes, ["host", "template", "branch"])
    grown = at.join(known, ["host", "template", "segment"])
    return grown.select(
        "host",
        "path_key",
        "segments",
        F.when(F.col("branch") == "", F.col("template")).otherwise(F.concat("template", F.lit("/"), "branch")).alias("template"),
        "labelled",
        "bad",
        F.when(F.col("branch") == "", F.col("purity")).otherwise(F.col("node_purity")).alias("purity"),
    )


def template_tree(urls: DataFrame) -> DataFrame:
    """(host, path_key, template, purity) for every host and generalised path.

    ``urls`` holds host, path and bad (1, 0 or null where unlabelled).
    """
    leaves = (
        urls.withColumn("segments", segments(F.col("path")))
        .groupBy("host", "segments")
        .agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    leaves = leaves.withColumn("path_key", F.array_join("segments", "/"))
    leaves = durable(leaves)
    seen = leaves.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b")).first()
    overall = seen["b"] / seen["n"] if seen["n"] else 0.0
    per_host = leaves.groupBy("host").agg(
        ((F.sum("bad") + SMOOTHING * overall) / (F.sum("labelled") + SMOOTHING)).alias("purity")
    )
    grown = durable(leaves.join(per_host, "host").withColumn("template", F.lit("")))
    placed, level = [], 0
    while True:
        settled, grown = _settled(grown, level)
        placed.append(settled)
        if grown.isEmpty():
            break
        grown = durable(_grow(grown, level))
        # a path that ends here has counted for its parent and keeps its template from now on
        ended = F.size("segments") <= level
        placed.append(grown.filter(ended))
        grown = grown.filter(~ended)
        level += 1
    names = ["host", "path_key", "template", "purity"]
    return reduce(DataFrame.unionByName, [part.select(*names) for part in placed])


def _settled(grown: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Paths of templates that no later round can part, with their final template and purity, and the others.

    All their branches are similar to their parent, so every segment left is a wildcard.
    """
    groups = grown.groupBy("host", "template").agg(F.sum("labelled").alias("all_n"), F.count(F.lit(1)).alias("paths"))
    known = durable(grown.join(groups, ["host", "template"]))
    alone = (F.col("all_n") == 0) | (F.col("paths") == 1)
    left = F.greatest(F.size("segments") - level, F.lit(0))
    share = F.when(F.col("all_n") > 0, F.col("bad") / F.col("all_n"))
    # each segment left moves the purity towards the share by the same part
    nearer = share + (F.col("purity") - share) * F.pow(SMOOTHING / (F.col("all_n") + SMOOTHING), left)
    final = known.filter(alone).withColumns(
        {"template": F.concat("template", F.repeat(F.lit("/*"), left)), "purity": F.coalesce(nearer, F.col("purity"))}
    )
    return final, known.filter(~alone).drop("all_n", "paths")


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row of ``pages``.

    ``labels`` holds page_id and bad (1 or 0) for some pages.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    label = labels.select(F.col("page_id"), F.col("bad").cast("long").alias("bad"))
    tree = template_tree(parsed.join(label, "page_id", "left").select("host", "path", "bad"))
    keyed = parsed.withColumn("path_key", F.array_join(segments(F.col("path")), "/"))
    judged = keyed.join(tree, ["host", "path_key"], "left")
    host, path = F.col("host"), F.col("path")
    learned = F.when(F.col("purity") >= BLOCK_PURITY, BLOCK).otherwise(ALLOW)
    return judged.select(
        "page_id",
        "host",
        "path",
        _first_fit(rules, host, path, lambda rule: rule.host + rule.path).alias("rule"),
        F.coalesce(_first_fit(rules, host, path, lambda rule: rule.verdict), learned).alias("verdict"),
        "template",
        "purity",
    )
