"""URL filter by path-template trees.

Per host, the segments of paths form a tree. Digits are generalised first; a segment that is one of many rare ones
under its parent becomes a wildcard, until nothing changes; what then reads alike is one branch. From the leaves up to the root,
labelled branches under one parent whose shares of blocked pages do not differ significantly are merged. A template is rejected when
the share of blocked pages among its labelled ones, smoothed by a prior, is high enough.
Labels come from the given rules, so the trees carry the rules' verdicts to paths that no rule names.
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions.columns import named
from tenderlake.llm.graph import whole_row
from tenderlake.session import staged

BLOCK, ALLOW = "block", "allow"
RULES = {"net/": BLOCK, "example.net/en/": ALLOW, "example.com/de/": BLOCK, "org/fr/": ALLOW}
#: A parent with more different segments below it has variable segments.
MOST_BRANCHES = 20
#: Prior share of blocked pages, the number of pages it weighs, and the share that rejects.
PRIOR_SHARE, PRIOR_PAGES, REJECT_SHARE = 0.1, 4.0, 0.5
#: A page that no rule names counts as this much of an allowed one.
UNNAMED_WEIGHT = 0.1
#: Branches differ when their shares lie this many standard errors apart.
DIFFERENT = 1.96
LEAST_LABELLED = 5
#: How a merged segment begins; no segment of a path holds a slash.
MERGED = "/"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands behind ``://`` up to ``/ ? #``, A-Z lower-cased, and from there up to ``? #``."""
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def match_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits host (or a domain above it) and the beginning of the path; else null."""
    tests = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        domain, slash, start = rule.partition("/")
        fits = (host == domain) | F.endswith(host, F.lit("." + domain))
        tests.append(F.when(fits & F.startswith(path, F.lit(slash + start)), F.lit(rule)))
    return F.coalesce(*tests, F.lit(None).cast("string"))


def _generalised(path: Column) -> Column:
    """Segments with runs of digits as ``#``, and long hexadecimal or mixed tokens as ``*``."""
    segments = F.split(F.regexp_replace(path, r"^/", ""), "/")
    return F.transform(segments, lambda s: F.when(s.rlike(r"^[0-9a-fA-F-]{16,}$"), F.lit("*")).otherwise(F.regexp_replace(s, r"[0-9]+", "#")))


def _with_wildcards(tree: DataFrame) -> DataFrame:
    """Replace rare segments under parents with many branches; equal templates become one row."""
    nodes = tree.select("host", "pages", F.col("template").alias("whole"), F.posexplode("template").alias("depth", "segment"))
    nodes = nodes.withColumn("parent", F.concat_ws("/", F.slice("whole", 1, F.col("depth"))))
    branches = nodes.groupBy("host", "parent", "depth", "segment").agg(F.sum("pages").alias("n"))
    parents = branches.groupBy("host", "parent", "depth").agg(F.count("*").alias("kinds"), F.sum("n").alias("total"))
    rare = branches.join(parents.where(F.col("kinds") > MOST_BRANCHES), ["host", "parent", "depth"]).where(
        F.col("n") * MOST_BRANCHES < F.col("total")
    )
    wild = nodes.join(rare.select("host", "parent", "depth", "segment").withColumn("rare", F.lit(True)), ["host", "parent", "depth", "segment"], "left")
    marks = wild.where("rare").groupBy("host", "whole").agg(F.collect_set("depth").alias("wild"))
    out = tree.join(marks, (tree["host"] == marks["host"]) & (tree["template"] == marks["whole"]), "left").select(
        tree["*"],
        F.transform("template", lambda s, i: F.when(F.array_contains(F.coalesce("wild", F.array().cast("array<int>")), i), F.lit("*")).otherwise(s)).alias("next"),
    )
    return out


def alike_branches(counts: list[tuple[int, int]]) -> list[int]:
    """For blocked and allowed pages of siblings the group of each: the two neighbours by share that differ least are
    merged as long as they do not differ significantly."""
    groups = sorted(([b, a, [i]] for i, (b, a) in enumerate(counts)), key=lambda g: (g[0] / (g[0] + g[1]), g[2]))

    def apart(x: list, y: list) -> float:
        n, m = x[0] + x[1], y[0] + y[1]
        share = (x[0] + y[0]) / (n + m)
        error = math.sqrt(share * (1 - share) * (1 / n + 1 / m))
        return abs(x[0] / n - y[0] / m) / error if error else 0.0

    while len(groups) > 1:
        least, i = min((apart(groups[i], groups[i + 1]), i) for i in range(len(groups) - 1))
        if least > DIFFERENT:
            break
        x, y = groups[i : i + 2]
        groups[i : i + 2] = [[x[0] + y[0], x[1] + y[1], x[2] + y[2]]]
    found = [0] * len(counts)
    for _, _, members in groups:
        for i in members:
            found[i] = min(members)
    return found


def _branches(tree: DataFrame) -> DataFrame:
    """Branches with labels enough to be compared: ``host, merged, blocked, allowed``."""
    branch = tree.groupBy("host", "merged").agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"))
    return branch.where(F.col("blocked") + F.col("allowed") >= LEAST_LABELLED)


def _family(depth: Column) -> Column:
    """The branch without its segment at a depth: equal for siblings that differ there only."""
    return F.transform("merged", lambda s, i: F.when(i == depth, F.lit("")).otherwise(s))


def _deepest_siblings(tree: DataFrame, above: int | None) -> int | None:
    """The greatest depth (above the given one) at which branches have siblings; null if there is none.

    Only such depths cost a pass, so paths of any length do not.
    """
    places = _branches(tree).select("host", "merged", F.posexplode("merged").alias("depth", "segment"))
    if above is not None:
        places = places.where(F.col("depth") < above)
    families = places.groupBy("host", "depth", F.xxhash64(_family(F.col("depth"))).alias("family")).agg(F.count("*").alias("n"))
    return families.where("n > 1").agg(F.max("depth")).first()[0]


def _merged_siblings(tree: DataFrame, depth: int) -> DataFrame:
    """Labelled branches under one parent that differ in the segment at ``depth`` only, and whose shares do not differ
    significantly, read alike in ``merged``, the template as far as it is merged so far; ``template`` stays.

    Rare segments are wildcards by now, so a parent has at most about ``MOST_BRANCHES`` branches.
    """

    @F.pandas_udf("array<int>")
    def groups(members: pd.Series) -> pd.Series:
        return pd.Series([alike_branches([(m["blocked"], m["allowed"]) for m in ms]) for ms in members], dtype=object)

    branch = _branches(tree.where(F.size("merged") > depth))
    members = F.array_sort(F.collect_list(F.struct("merged", "blocked", "allowed")))
    whole = branch.groupBy("host", _family(F.lit(depth)).alias("family")).agg(members.alias("members")).where(F.size("members") > 1)
    grouped = whole.withColumn("groups", groups("members")).select("host", "members", "groups", F.posexplode("groups").alias("place", "group"))
    same = F.size(F.filter("groups", lambda g: g == F.col("group"))) > 1
    alike = grouped.where(same).select("host", F.element_at("members", F.col("place") + 1)["merged"].alias("merged"), F.concat(F.lit(MERGED), F.col("group")).alias("alike"))
    wild = F.transform("merged", lambda s, i: F.when(i == depth, F.col("alike")).otherwise(s))
    return tree.join(alike, ["host", "merged"], "left").withColumn("merged", F.when(F.col("alike").isNotNull(), wild).otherwise(F.col("merged"))).drop("alike")


def rejected_templates(judged: DataFrame) -> DataFrame:
    """``host, first, template, purity``: the tree of each host; ``first`` is the path before wildcards.

    ``judged`` has ``host, path`` and ``label`` (block, allow, or null).
    """
    label = lambda v: F.sum(F.when(F.col("label") == v, 1).otherwise(0))
    tree = staged(
        judged.groupBy("host", _generalised(F.col("path")).alias("template")).agg(
            F.count("*").alias("pages"), label(BLOCK).alias("blocked"), label(ALLOW).alias("allowed"),
            F.sum(F.when(F.col("label").isNull(), 1).otherwise(0)).alias("unnamed"),
        ).withColumn("first", F.col("template"))
    )
    deepest = tree.agg(F.max(F.size("template"))).first()[0] or 0
    for _ in range(deepest):  # a pass settles one depth at least
        passed = staged(_with_wildcards(tree))
        changed = not passed.where(F.col("next") != F.col("template")).isEmpty()
        tree = passed.drop("template").withColumnRenamed("next", "template")
        if not changed:
            break
    sums = [F.sum(c).alias(c) for c in ("blocked", "allowed", "unnamed")]
    merged = staged(tree.groupBy("host", "template").agg(*sums).withColumn("merged", F.col("template")))
    depth = _deepest_siblings(merged, None)
    while depth is not None:
        merged = staged(_merged_siblings(merged, depth))
        depth = _deepest_siblings(merged, depth)
    merged = merged.join(merged.groupBy("host", "merged").agg(*[F.sum(c).alias(f"m_{c}") for c in ("blocked", "allowed", "unnamed")]), ["host", "merged"])
    merged = merged.select("host", "template", *[F.col(f"m_{c}").alias(c) for c in ("blocked", "allowed", "unnamed")])
    seen = F.col("blocked") + F.col("allowed") + UNNAMED_WEIGHT * F.col("unnamed")
    purity = (F.col("blocked") + PRIOR_PAGES * PRIOR_SHARE) / (seen + PRIOR_PAGES)
    scored = merged.select("host", "template", purity.alias("purity"))
    return staged(tree.select("host", "first", "template").join(scored, ["host", "template"]))


def judge_urls(pages: DataFrame, url: str = "url", rules: dict[str, str] | None = None) -> DataFrame:
    """Add ``host, path, rule, template, purity, verdict``.

    The rule's verdict holds where a rule fits (the longest; it fits its host, all subdomains, and paths
    that start with its path), else ``block`` where the template's purity reaches
    ``REJECT_SHARE``, else ``allow``. Null URLs and URLs without ``://`` have empty host and path
    and are judged as such. Repeated rows are judged alike; an empty table stays empty;
    further columns pass through whatever their names, except that columns with these names are replaced.
    """
    rules = RULES if rules is None else rules
    added = ("host", "path", "rule", "template", "purity", "verdict")
    host, path = host_and_path(named(url))
    rows = pages.select(whole_row(pages.drop(*added)), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", match_rule(F.col("host"), F.col("path"), rules))
    verdict = reduce(lambda c, r: c.when(F.col("rule") == r, F.lit(rules[r])), rules, F.when(F.lit(False), F.lit(None).cast("string")))
    labelled = rows.withColumn("label", verdict)
    trees = rejected_templates(labelled.select("host", "path", "label"))
    trees = trees.select("host", "first", F.concat(F.lit("/"), F.concat_ws("/", "template")).alias("template"), "purity")
    found = labelled.withColumn("first", _generalised(F.col("path"))).join(trees, ["host", "first"], "left")
    judged = F.coalesce("label", F.when(F.col("purity") >= REJECT_SHARE, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return found.select("row.*", "host", "path", "rule", "template", "purity", judged.alias("verdict"))
