"""URL filter: rules first, else a tree of path templates judged by smoothed labelled purity."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from feedgate.llm.common import staged
from feedgate.session import work_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Levels that the SQL counterpart writes out; the operator's tree has as many as its paths.
DEPTH = 4
#: A level with this many different segments is variable: segments below ``RARE`` of it are wild.
MANY = 8
RARE = 0.05
#: Siblings within this many standard errors of their common share are one branch.
ERRORS = 2.0
#: Labelled URLs that a prior weighs, and the share of bad ones from which a template is rejected.
PRIOR = 8.0
REJECT = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path after the first ``://``; both empty without one or if null."""
    def part(group):
        return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))

    return F.translate(part(1), UPPER, LOWER), part(2)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``struct(rule, verdict)`` of the longest rule ``(verdict, host, path)`` that fits, else null.

    A rule fits its host and its subdomains where the path starts with the rule's.  Rules are a
    list in the program, not a table.
    """
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def shape(path: Column) -> Column:
    """Segments of a path; runs of digits and long hexadecimal names as signs."""
    known = F.regexp_replace(path, "(^|/|-|_)[0-9a-fA-F]{16,}(/|-|_|[.]|$)", "$1{hex}$2")
    known = F.regexp_replace(known, "[0-9]+", "{n}")
    return F.split(F.regexp_replace(known, "^/", ""), "/", -1)


def path_templates(urls: DataFrame) -> DataFrame:
    """``host, segments, template, parent`` for each distinct host and shape of ``urls``.

    ``urls`` has ``host, segments, rows``.  The tree is generalised level by level: below one
    template so far, segments are counted; where there are ``MANY`` different ones, those with less
    than ``RARE`` of the rows become a wildcard, and paths that are now alike share what follows.
    Each level counts per task first and joins the counts back by (host, template, segment); a hot
    host's join is split by adaptive execution.  Below a template with fewer than ``MANY`` shapes
    nothing can become a wildcard, so they end there with all their segments; only others go on.
    """
    spark, path = urls.sparkSession, work_dir(urls.sparkSession, "url-tree")
    tree = urls.withColumn("template", F.lit("")).withColumn("parent", F.lit(""))
    for level in count():
        here = tree.withColumn("segment", F.get("segments", F.lit(level)))
        at = here.groupBy("host", "template", "segment").agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("shapes"))
        below = at.groupBy("host", "template").agg(
            F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"), F.sum("shapes").alias("below")
        )
        wild = (F.col("kinds") >= MANY) & (F.col("n") < F.col("all") * RARE)
        names = at.join(below, ["host", "template"]).select(
            "host", "template", "segment", F.when(wild, F.lit("*")).otherwise(F.col("segment")).alias("name"),
            (F.col("below") < MANY).alias("few"),
        )
        rest = F.slice("segments", F.lit(level + 1), F.size("segments") - level)
        before = F.slice("segments", F.lit(level + 1), F.size("segments") - level - 1)
        joined = here.join(names, ["host", "template", "segment"]).select(
            "host", "segments", "rows", "labelled", "bad",
            F.concat("template", F.lit("/"), F.when(F.col("few"), F.array_join(rest, "/")).otherwise(F.col("name"))).alias("template"),
            F.when(F.col("few") & (F.size(before) > 0), F.concat("template", F.lit("/"), F.array_join(before, "/")))
            .otherwise(F.col("template")).alias("parent"),
            (~F.col("few") & (F.size("segments") > level + 1)).alias("more"),
        )
        joined.write.parquet(f"{path}/level={level}")
        tree = spark.read.schema(joined.schema).parquet(f"{path}/level={level}").filter("more").drop("more")
        if tree.isEmpty():
            return spark.read.schema(joined.schema).parquet(path).filter("not more").drop("more", "level")


def judged_templates(tree: DataFrame) -> DataFrame:
    """``host, template, branch, purity`` of each template: its smoothed share of bad labels.

    Siblings whose share lies within ``ERRORS`` standard errors of their common share merge into
    one branch (``~``) and pool their labels; the others stay alone.  A branch's share is smoothed
    towards its host's, that towards the share of all labelled URLs (one half without any).
    Templates without labels thus get their branch's or host's share.
    """
    leaves = tree.groupBy("host", "parent", "template").agg(
        F.sum("rows").alias("rows"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")
    )
    hosts = leaves.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("bad").alias("host_bad"))
    total = hosts.agg(F.sum("host_labelled").alias("n"), F.sum("host_bad").alias("b")).first()  # one row
    overall = total["b"] / total["n"] if total["n"] else 0.5
    common = leaves.groupBy("host", "parent").agg(
        F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad")
    )
    share, whole = F.try_divide("bad", "labelled"), F.try_divide("all_bad", "all_labelled")
    alike = (F.col("labelled") == 0) | (
        F.abs(share - whole) <= F.sqrt(F.try_divide(whole * (1 - whole), F.col("labelled"))) * ERRORS
    )
    branches = leaves.join(common, ["host", "parent"]).withColumn(
        "branch", F.when(alike, F.concat("parent", F.lit("/~"))).otherwise(F.col("template"))
    )
    pooled = branches.groupBy("host", "branch").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    prior = (F.col("host_bad") + overall * PRIOR) / (F.col("host_labelled") + PRIOR)
    purity = (F.col("b") + prior * PRIOR) / (F.col("n") + PRIOR)
    rated = pooled.join(hosts, "host").select("host", "branch", purity.alias("purity"))
    return branches.join(rated, ["host", "branch"]).select("host", "template", "branch", "purity")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """All rows and columns of ``pages`` with ``host, path, rule, template, purity, verdict``.

    URLs that a rule decides are the labels: blocked ones are bad.  All URLs build the tree; a URL
    without a rule is blocked when its template's purity reaches ``REJECT``.  Null URLs and those
    without ``://`` have empty host and path, and are judged as one host like any other.  Rows may
    repeat and count each.  Columns of ``pages`` with these names are replaced.
    """
    host, path = host_and_path(F.col("url"))
    found = pages.withColumns({"host": host, "path": path})
    found = found.withColumn("_match", matched_rule(F.col("host"), F.col("path"), rules))
    found = found.withColumns(
        {"rule": F.col("_match.rule"), "_ruled": F.col("_match.verdict"), "_segments": shape(F.col("path"))}
    ).drop("_match")
    shapes = found.groupBy("host", F.col("_segments").alias("segments")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("_ruled").alias("labelled"),
        F.count(F.when(F.col("_ruled") == "block", 1)).alias("bad"),
    )
    tree = path_templates(staged(shapes, "url-shapes"))
    judged = tree.select("host", "segments", "template").join(judged_templates(tree), ["host", "template"])
    judged = staged(judged.withColumnRenamed("segments", "_segments").drop("branch"), "url-judged")
    own = [c for c in found.columns if c not in ("template", "purity", "verdict", "_ruled", "_segments")]
    rejected = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return found.drop("template", "purity", "verdict").join(judged, ["host", "_segments"]).select(
        *[F.col(f"`{c}`") for c in own], "template", "purity", F.coalesce("_ruled", rejected).alias("verdict")
    )
