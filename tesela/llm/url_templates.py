"""URL filters: host and path rules, then a path-template tree.

Rules decide the URLs they fit; the longest fitting rule wins. For the rest
a tree of path templates is built per host:

1. Segments that are numbers, hex ids or contain digits become typed
   wildcards (``{n}``, ``{h}``).
2. Level by level, under each (host, template so far): a node whose children
   are very many and thinly used gets one wildcard ``*`` for all of them.
   Elsewhere, children that are statistically similar merge into one branch:
   those whose Wilson interval of the blocked share lies on the same side
   (all below, all above, or around one half) and whose usual next segment
   is of the same kind.
3. Each node's purity is the share of pages that rules block, smoothed
   towards its parent's: ``(blocked + a * parent) / (labelled + k *
   unlabelled + a)``; a page no rule fits counts for ``k`` of a labelled
   one. A page is rejected if its template's purity reaches the limit and
   rules block at least ``SUPPORT`` pages of its first-level branch.

All work is done on counts per distinct (host, typed path), native functions
only; the page table is read twice and never grouped whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared
from .util import join_counted

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
DEPTH = 4  # levels that may be generalised; deeper segments stay one typed tail
MANY = 24  # children from which a node may become a wildcard
THIN = 4.0  # and pages per child below which it does
SMOOTH = 5.0
UNLABELLED = 0.25
PURITY = 0.8
SUPPORT = 5
Z = 1.96


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as written; both empty without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Longest fitting rule as ``host + path`` and its verdict (else null)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the longest is asked last, so it is the outermost case; of equal length the later rule of the list
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def typed_segments(path: Column) -> Column:
    """Segments of a path without its first slash, variable ones typed."""
    def kind(s: Column) -> Column:
        return (F.when(s.rlike("^[0-9]+$"), F.lit("{n}")).when(s.rlike("^[0-9a-fA-F-]*[0-9][0-9a-fA-F-]*$") & (F.length(s) >= 8), F.lit("{h}"))
                .otherwise(F.regexp_replace(s, "[0-9]+", "{n}")))
    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), kind)


def _side(blocked: Column, pages: Column) -> Column:
    """Which side of one half the Wilson interval of blocked / pages is on."""
    p = blocked / pages
    mid = (p + Z * Z / (2 * pages)) / (1 + Z * Z / pages)
    half = Z * F.sqrt(p * (1 - p) / pages + Z * Z / (4 * pages * pages)) / (1 + Z * Z / pages)
    return F.when(mid + half < 0.5, F.lit("-")).when(mid - half > 0.5, F.lit("+")).otherwise(F.lit("~"))


def template_purity(paths: DataFrame, folder: str) -> DataFrame:
    """``host, typed, template, purity, support`` of each distinct typed path.

    ``paths``: ``host, typed`` (segments joined by /), ``pages``,
    ``blocked``, ``labelled``, one row each.
    """
    total = paths.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    prior = ((total["b"] or 0) + 1.0) / ((total["l"] or 0) + 2.0)

    def smoothed(blocked: Column, labelled: Column, pages: Column, parent: Column) -> Column:
        return (blocked + SMOOTH * parent) / (labelled + UNLABELLED * (pages - labelled) + SMOOTH)

    counts = [F.sum(c).alias(f"{c}_at") for c in ("pages", "blocked", "labelled")]
    segs = F.split("typed", "/")
    root = paths.groupBy("host").agg(*counts).select("host", smoothed(F.col("blocked_at"), F.col("labelled_at"), F.col("pages_at"), F.lit(prior)).alias("purity"))
    tree = paths.join(root, "host").select("host", "typed", "pages", "blocked", "labelled", F.lit("").alias("template"), "purity", F.lit(0).cast("long").alias("support"))
    for k in range(DEPTH + 1):
        # the last step takes all deeper segments as one tail
        seg = F.get(segs, F.lit(k)) if k < DEPTH else F.when(F.size(segs) > DEPTH, F.array_join(F.slice(segs, DEPTH + 1, 1 << 20), "/"))
        after = F.coalesce(F.get(segs, F.lit(k + 1)), F.lit("")) if k < DEPTH else F.lit("")
        tree = tree.withColumn("seg", seg).withColumn("after", F.when(after.startswith("{"), after).otherwise(F.when(after == "", after).otherwise(F.lit("w"))))
        node = ["host", "template", "seg"]
        children = tree.where("seg is not null").groupBy(*node, "after").agg(*counts)
        children = children.groupBy(*node).agg(*(F.sum(f"{c}_at").alias(f"{c}_at") for c in ("pages", "blocked", "labelled")), F.max(F.struct("pages_at", "after"))["after"].alias("usual"))
        children = shared.written(children, f"children-{k}", folder)
        many = children.groupBy("host", "template").agg(F.count("*").alias("n"), F.sum("pages_at").alias("all"))
        wide = (F.col("n") >= MANY) & (F.col("all") < THIN * F.col("n"))
        branch = F.when(wide, F.lit("*")).otherwise(F.concat(F.lit("*"), _side(F.col("blocked_at"), F.col("pages_at")), F.col("usual")))
        merged = children.join(many, ["host", "template"]).withColumn("branch", branch)
        sums = merged.groupBy("host", "template", "branch").agg(F.count("*").alias("width"), *(F.sum(f"{c}_at").alias(f"{c}_sum") for c in ("pages", "blocked", "labelled")))
        merged = merged.join(sums, ["host", "template", "branch"]).select(*node, F.when(F.col("width") > 1, F.col("branch")).otherwise(F.col("seg")).alias("step"), "pages_sum", "blocked_sum", "labelled_sum")
        merged = shared.written(merged, f"merged-{k}", folder)
        tree = join_counted(tree, merged, node)
        here = F.col("step").isNotNull()
        tree = tree.select("host", "typed", "pages", "blocked", "labelled",
                           F.when(here, F.concat("template", F.lit("/"), "step")).otherwise(F.col("template")).alias("template"),
                           F.when(here, smoothed(F.col("blocked_sum"), F.col("labelled_sum"), F.col("pages_sum"), F.col("purity"))).otherwise(F.col("purity")).alias("purity"),
                           (F.coalesce("blocked_sum", F.lit(0)) if k == 0 else F.col("support")).cast("long").alias("support"))
        tree = shared.written(tree, f"tree-{k}", folder)
    return tree.select("host", "typed", "template", "purity", "support")


def judge(pages: DataFrame, url: str = "url", page_id: str = "page_id", rules=RULES) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict``
    and ``template, purity`` of its path.

    A null URL, or one without ``://``, has an empty host and path (one
    template of its own). Repeated rows count as often as they stand there.
    Other columns are not read. An empty table gives no row.
    """
    folder = shared.new_folder(pages.sparkSession, "urls")
    host, path = host_and_path(F.col(url).cast("string"))
    parts = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, told = fitting_rule(F.col("host"), F.col("path"), rules)
    parts = parts.select("*", rule.alias("rule"), told.alias("told"), F.array_join(typed_segments(F.col("path")), "/").alias("typed"))
    paths = parts.groupBy("host", "typed").agg(F.count("*").alias("pages"), F.count_if(F.col("told") == "block").alias("blocked"), F.count("told").alias("labelled"))
    verdicts = template_purity(shared.written(paths, "paths", folder), folder)
    verdicts = shared.written(verdicts, "verdicts", folder)
    method = F.when((F.col("purity") >= PURITY) & (F.col("support") >= SUPPORT), F.lit("block")).otherwise(F.lit("allow"))
    return join_counted(parts, verdicts, ["host", "typed"]).select("page_id", "host", "path", "rule", F.coalesce("told", method).alias("verdict"), "template", "purity")
