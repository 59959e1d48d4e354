"""URL filter: listed rules first, then a path-template tree per host with labelled purity.

The tree is learned from all pages' urls. Pages are first counted by (host, lexical template): each path
segment with its digit runs replaced by ``*``. From then on only those counts are worked on, level by
level, so a host that holds a third of all pages is a few rows once its variable segments are
generalised:

1. generalise: below a (host, prefix), rare segments become ``*~0`` when they are many. A segment with
   more pages than that (``*``, the numbers, is one) stays a branch with its own labels, for the merge;
2. merge: siblings (same host, same other segments) are put in order of their labelled rates; one that
   doesn't differ by more than ``z`` standard errors from the pooled rate of the class built so far joins
   that class, which becomes one branch, deepest level first;
3. judge: a template's rate of bad labels is smoothed towards its host's, a host's towards that of all
   pages, and that towards ``prior``; templates whose purity falls below ``least_purity`` are rejected.

A listed rule ``host/path`` fits its host and all subdomains when the url's path starts with its path; the
longest fitting rule decides, and templates judge only urls that no rule fits.

Defined results:
* null url or none with ``://``: host, path and template are empty; no rule fits; it is judged by the
  template of all such urls like any other;
* null ids are listed; repeated pages count as often as they occur; labels are taken once for each
  page id (bad if any of its labels is);
* no labels: nothing is rejected; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from math import sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..config import cut_lineage

MANY_CHILDREN = 20  # rare children from which a level counts as variable
RARE_SHARE = 0.2  # children per page: a child of up to 1 / RARE_SHARE pages is rare
RARE = "*~0"  # no segment is written so: digits are replaced


def host_of(url: str) -> Column:
    raw = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; null where none fits. ``rules``: (verdict, host/path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), len(r[1].partition("/")[0]), r[1])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def segments() -> Column:
    """Path segments with digit runs as ``*``."""
    return F.transform(F.split(F.col("path"), "/"), lambda s: F.regexp_replace(s, "[0-9]+", "*"))


def next_variable_level(tree: DataFrame, after: int) -> int | None:
    """The first level below ``after`` at which some (host, prefix) has many rare children."""
    at = F.explode(F.sequence(F.lit(after + 1), F.size("template") - 1)).alias("level")
    parts = tree.where(F.size("template") > after + 1).select("host", "template", "n", at)
    prefix = F.xxhash64("host", F.expr("slice(template, 1, level)"))
    pages = parts.groupBy("level", prefix.alias("prefix"), F.expr("template[level]").alias("child")).agg(F.sum("n").alias("pages"))
    many = pages.where(F.col("pages") * RARE_SHARE <= 1).groupBy("level", "prefix").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= MANY_CHILDREN)
    return many.agg(F.min("level").alias("l")).collect()[0].l


def next_family_level(tree: DataFrame, before: int | None) -> int | None:
    """The deepest level above ``before`` at which some templates are siblings: alike but for their segment there.

    So a round is spent on levels that have something to merge, not on every level of the deepest path.
    """
    top = F.size("template") - 1 if before is None else F.least(F.size("template") - 1, F.lit(before - 1))
    at = F.explode(F.when(top >= 1, F.sequence(F.lit(1), top))).alias("level")
    parts = tree.select("host", "template", at)
    others = F.expr("concat(slice(template, 1, level), array('*'), slice(template, level + 2, size(template)))")
    families = parts.groupBy("level", F.xxhash64("host", others).alias("family")).agg(
        F.min(F.xxhash64("template")).alias("x"), F.max(F.xxhash64("template")).alias("y")).where("x <> y")
    return families.agg(F.max("level").alias("l")).collect()[0].l


def generalised(tree: DataFrame) -> DataFrame:
    """Replace the rare children of variable (host, prefix) nodes by ``RARE``, from the root down."""
    level = 0  # segment 0 is the empty one before the first slash
    while (level := next_variable_level(tree, level)) is not None:
        here = (tree.where(F.size("template") > level)
                .groupBy("host", F.slice("template", 1, level).alias("prefix"), F.col("template")[level].alias("child"))
                .agg(F.sum("n").alias("pages")).where(F.col("pages") * RARE_SHARE <= 1))
        variable = here.groupBy("host", "prefix").agg(F.count(F.lit(1)).alias("children")).where(F.col("children") >= MANY_CHILDREN)
        rare = here.join(variable, ["host", "prefix"]).select("host", "prefix", "child", F.lit(True).alias("v"))
        tree = cut_lineage(
            tree.withColumn("prefix", F.slice("template", 1, level)).withColumn("child", F.get("template", F.lit(level)))
            .join(rare, ["host", "prefix", "child"], "left")
            .withColumn("template", F.when(F.coalesce("v", F.lit(False)), replaced(level, F.lit(RARE))).otherwise(F.col("template")))
            .drop("prefix", "child", "v"))
    return tree


def replaced(level: int, name: Column) -> Column:
    """The template with its segment at ``level`` replaced."""
    return F.concat(F.slice("template", 1, level), F.array(name),
                    F.slice("template", level + 2, F.greatest(F.size("template") - level - 1, F.lit(0))))


def differs(b: int, n: int, pooled_b: int, pooled_n: int, z: float) -> bool:
    """Whether b of n is a higher rate than the pooled one by more than ``z`` standard errors."""
    if not n or not pooled_n:
        return False
    rate = (b + pooled_b) / (n + pooled_n)
    return b / n - pooled_b / pooled_n > z * sqrt(rate * (1 - rate) * (1 / n + 1 / pooled_n))


def classed(branches: DataFrame, z: float) -> DataFrame:
    """(host, family, template, class) of siblings with ``n`` labels, ``b`` of them bad.

    A task reads its families in order of rate and holds one class at a time, as its two sums.
    """
    def run(batches):
        of, number, pooled_b, pooled_n = None, 0, 0, 0
        for batch in batches:
            out = []
            for host, family, n, b in zip(*(batch.column(c).to_pylist() for c in ("host", "family", "n", "b"))):
                if (host, family) != of:
                    of, number, pooled_b, pooled_n = (host, family), 0, 0, 0
                elif differs(b, n, pooled_b, pooled_n, z):
                    number, pooled_b, pooled_n = number + 1, 0, 0
                pooled_b, pooled_n = pooled_b + b, pooled_n + n
                out.append(number)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("host", "family", "template")), pa.array(out, pa.int64())],
                                             ["host", "family", "template", "class"])

    ordered = branches.repartition("host", "family").sortWithinPartitions("host", "family", F.try_divide("b", "n").asc_nulls_first(), "template")
    return ordered.mapInArrow(run, "host string, family array<string>, template array<string>, class long")


def merged(tree: DataFrame, z: float) -> DataFrame:
    """Merge siblings of like labelled rates, deepest level first.

    Siblings are put in order of their rates; one that differs from the class so far starts a new
    class. A class of several becomes ``*`` (the class of the lowest rate, if no other class has that
    segment) or ``*~k``.
    """
    level = None
    while (level := next_family_level(tree, level)) is not None:
        branches = (tree.where(F.size("template") > level)
                    .select("host", "template", replaced(level, F.lit("*")).alias("family"), "labelled", "bad")
                    .groupBy("host", "family", "template").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b")))
        family = Window.partitionBy("host", "family")
        own = F.max((F.col("template")[level] == "*") & (F.col("class") > 0)).over(family)
        classes = (classed(branches, z)
                   .withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("host", "family", "class")))
                   .withColumn("own", own).where("members > 1")
                   .select("host", "template", F.when((F.col("class") == 0) & ~F.col("own"), F.lit("*")).otherwise(
                       F.concat(F.lit("*~"), (F.col("class") + 1).cast("string"))).alias("name")))
        tree = cut_lineage(
            tree.join(classes, ["host", "template"], "left")
            .withColumn("template", F.when(F.col("name").isNotNull(), replaced(level, F.col("name"))).otherwise(F.col("template")))
            .drop("name"))
    return tree


def template_tree(pages: DataFrame, z: float = 1.96, smoothing: float = 20.0, least_purity: float = 0.5, prior: float = 0.1) -> DataFrame:
    """(host, lexical, template, labelled, purity, rejected) of every lexical template.

    ``pages`` has host, path and bad (1, 0, or null where a page has no label).
    """
    counts = pages.groupBy("host", segments().alias("lexical")).agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    tree = cut_lineage(counts.withColumn("template", F.col("lexical")))
    tree = merged(generalised(tree), z)
    total = tree.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + smoothing * prior) / (F.coalesce(F.sum("labelled"), F.lit(0)) + smoothing)).alias("r")).scalar()
    hosts = tree.groupBy("host").agg(((F.sum("bad") + smoothing * total) / (F.sum("labelled") + smoothing)).alias("host_rate"))
    judged = (tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).join(hosts, "host")
              .withColumn("purity", 1 - (F.col("bad") + smoothing * F.col("host_rate")) / (F.col("labelled") + smoothing))
              .select("host", "template", "labelled", "purity", (F.col("purity") < least_purity).alias("rejected")))
    return tree.select("host", "lexical", "template").join(judged, ["host", "template"])


def url_filter(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
               **tree) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every page; ``labels``: (page_id, bad 0/1)."""
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    known = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
    judged = cut_lineage(template_tree(rows.join(known, "page_id", "left"), **tree))
    rule, verdict = rule_of(rules)
    found = rows.withColumn("lexical", segments()).join(
        judged.select("host", "lexical", "template", "purity", "rejected"), ["host", "lexical"], "left")
    return found.select("page_id", "host", "path", rule.alias("rule"),
                        F.coalesce(verdict, F.when(F.coalesce("rejected", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                        F.array_join("template", "/").alias("template"), "purity")
