"""URL verdicts by host rules and, where no rule fits, by a tree of path templates.

1. Per host, paths become templates from the root down, as deep as at least ``least`` different paths share a prefix: a segment that varies
   (it holds a digit, or its node has nearly as many children as paths) turns into a wildcard, and what lies below is counted together.
2. The labels are the verdicts of the rules. From the leaves up, sibling branches whose labelled counts a G test cannot tell
   apart become one. A node whose labelled children all became one branch is compared with its own siblings in
   turn; a node with unlike children keeps them apart. Templates without labels join nothing.
3. A branch is rejected when its share of blocked labels, smoothed by ``weight`` urls of the share ``prior``, reaches a threshold;
   a template without labels is allowed.

Pages are counted per different path first; every step after that is an aggregation by host and prefix, and siblings with
equal counts are compared once, so no task sees all pages, paths or children of a host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources.staging import staged

# Rule, verdict.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
CRITICAL = 3.841  # of the G test with one degree of freedom at 5 %
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.char_length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.when(at > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.char_length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. ``rules`` is a short list of the caller."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + rest))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _prefix(length: int) -> Column:
    return F.array_join(F.slice("segs", 1, length), "/") if length else F.lit("")


def _wildcards(urls: DataFrame, variety: float, least: int) -> DataFrame:
    """Different (host, path) with ``segs``: the path's segments, those that vary as wildcards."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    shaped = F.transform(segments, lambda s: F.when(F.regexp_like(s, F.lit(r"\d")), F.lit("*")).otherwise(s))
    rows, level = urls.withColumn("segs", shaped), 0
    while True:
        here = rows.where(F.size("segs") > level).withColumns({"_node": _prefix(level), "_at": F.get("segs", F.lit(level))})
        values = here.groupBy("host", "_node", "_at").agg(F.count("*").alias("_n"))
        nodes = values.groupBy("host", "_node").agg(F.sum("_n").alias("_paths"), F.count(F.when(F.col("_at") != "*", 1)).alias("_kinds"))
        nodes = staged(nodes.where(F.col("_paths") >= least), "url_nodes")
        if nodes.isEmpty():
            return rows
        # A node whose children are nearly all different holds names, not structure.
        varied = nodes.where((F.col("_kinds") >= least) & (F.col("_kinds") >= variety * F.col("_paths"))).select("host", "_node")
        if not varied.isEmpty():
            marked = rows.withColumn("_node", _prefix(level)).join(varied.withColumn("_varied", F.lit(True)), ["host", "_node"], "left")
            star = F.transform("segs", lambda s, i: F.when(i == level, F.lit("*")).otherwise(s))
            rows = marked.withColumn("segs", F.when(F.col("_varied"), star).otherwise(F.col("segs"))).drop("_node", "_varied")
            rows = staged(rows, "url_templates")
        level += 1


def g_statistic(n: Column, b: Column, m: Column, c: Column) -> Column:
    """G of the counts b of n against c of m; 0 without rows on a side."""

    def part(seen: Column, rows: Column, all_seen: Column) -> Column:
        expected = rows * all_seen / (n + m)
        return F.when((seen > 0) & (expected > 0), seen * F.log(seen / expected)).otherwise(0.0)

    good = part(n - b, n, n - b + m - c) + part(m - c, m, n - b + m - c)
    return 2 * (part(b, n, b + c) + part(c, m, b + c) + good)


def _classes(nodes: DataFrame, prior: float, weight: float, critical: float) -> DataFrame:
    """Sibling nodes (host, parent, seg, n, b) with ``class``, the least segment of their branch, and the branch's n and b.

    Siblings stand in the order of their smoothed shares; where neighbours can be told apart, a new branch begins.
    """
    same = nodes.groupBy("host", "parent", "n", "b").agg(F.min("seg").alias("least"), F.count("*").alias("times"))
    share = (F.col("b") + prior * weight) / (F.col("n") + weight)
    order = Window.partitionBy("host", "parent").orderBy(share, "n")
    apart = g_statistic(F.col("n"), F.col("b"), F.lag("n").over(order), F.lag("b").over(order)) > critical
    runs = same.withColumn("_new", F.coalesce(apart, F.lit(False)).cast("int"))
    runs = runs.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    of_run = Window.partitionBy("host", "parent", "_run")
    runs = runs.select(
        "host", "parent", "n", "b", F.min("least").over(of_run).alias("class"),
        F.sum(F.col("n") * F.col("times")).over(of_run).alias("all_n"), F.sum(F.col("b") * F.col("times")).over(of_run).alias("all_b"),
    )
    return nodes.join(runs, ["host", "parent", "n", "b"])


def _branches(labelled: DataFrame, prior: float, weight: float, critical: float) -> DataFrame:
    """(host, template, branch) of labelled templates (host, template, segs, n, b): siblings merged from the leaves up."""
    depth = 0
    while not (
        labelled.where(F.size("segs") > depth).groupBy("host", _prefix(depth).alias("_node")).count().where("count > 1").isEmpty()
    ):
        depth += 1
    # Below ``depth`` no prefix has two labelled templates. A unit is a branch so far: where it lies, its counts, whether its node is one branch.
    cut = F.when(F.size("segs") > depth, F.concat(F.slice("segs", 1, depth), F.array(F.array_join(F.slice("segs", depth + 1, 1 << 30), "/"))))
    start = labelled.select("host", F.coalesce(cut, "segs").alias("segs"), "n", "b", F.col("template").alias("unit"), F.lit(True).alias("pure"))
    units = staged(start, "url_units")
    branch = staged(labelled.select("host", "template", F.col("template").alias("branch")), "url_branches")
    for level in range(depth, -1, -1):
        here = units.where(F.size("segs") == level + 1)
        nodes = here.groupBy("host", _prefix(level).alias("parent"), F.get("segs", F.lit(level)).alias("seg")).agg(
            F.sum("n").alias("n"), F.sum("b").alias("b"), F.min("unit").alias("unit"), F.bool_and("pure").alias("pure")
        )
        nodes = staged(nodes, "url_siblings")
        found = staged(_classes(nodes.where("pure"), prior, weight, critical), "url_classes")
        name = F.concat(F.lit(f"{level}:"), "parent", F.lit("/"), "class")
        moved = found.select("host", F.col("unit").alias("branch"), name.alias("_to"))
        branch = staged(
            branch.join(moved, ["host", "branch"], "left").select("host", "template", F.coalesce("_to", "branch").alias("branch")), "url_branches"
        )
        if not level:
            return branch
        parents = nodes.groupBy("host", "parent").agg(F.bool_and("pure").alias("_pure"))
        kinds = found.groupBy("host", "parent").agg(F.countDistinct("class").alias("_kinds"), F.max(name).alias("unit"), F.max("all_n").alias("n"), F.max("all_b").alias("b"))
        above = parents.join(kinds, ["host", "parent"], "left").withColumn("pure", F.col("_pure") & (F.col("_kinds") == 1))
        above = above.select(
            "host", F.split("parent", "/").alias("segs"), F.when(F.col("pure"), F.col("n")).otherwise(0).cast("long").alias("n"),
            F.when(F.col("pure"), F.col("b")).otherwise(0).cast("long").alias("b"),
            F.when(F.col("pure"), F.col("unit")).otherwise(F.concat(F.lit("mixed:"), "parent")).alias("unit"), "pure",
        )
        units = staged(units.where(F.size("segs") <= level).unionByName(above), "url_units")
    return branch


def _smoothed(blocked: Column, total: Column, prior: Column, weight: float) -> Column:
    return (blocked + prior * weight) / (total + weight)


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
    variety: float = 0.5, least: int = 20, weight: float = 4.0,
    prior: float = 0.1, threshold: float = 0.5, critical: float = CRITICAL,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, template, branch, score.

    A null url, or one without ``://``, has an empty host and path and is judged by its (empty) template. Repeated rows
    are judged and counted each; an empty table gives no rows; extra columns do not matter. A template without labels
    is allowed, whatever its neighbours. Equal shares stand in the order of their counts.
    """
    url = F.coalesce(F.col(url_col), F.lit(""))
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = staged(parsed.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules)), "url_parsed")
    urls = parsed.groupBy("host", "path").agg(F.count("_rule.verdict").alias("n"), F.count(F.when(F.col("_rule.verdict") == "block", 1)).alias("b"))
    shaped = _wildcards(staged(urls, "url_paths"), variety, least)
    template = F.concat(F.when(F.size("segs") > 0, F.lit("/")).otherwise(""), F.array_join("segs", "/"))
    shaped = staged(shaped.select("host", "path", "segs", template.alias("template"), "n", "b"), "url_shapes")
    counted = shaped.where("n > 0").groupBy("host", "template").agg(F.first("segs").alias("segs"), F.sum("n").alias("n"), F.sum("b").alias("b"))
    # A template that ends in a node is a child of that node like any other.
    counted = staged(counted.withColumn("segs", F.concat("segs", F.array(F.lit("")))), "url_counted")
    branch = _branches(counted, prior, weight, critical)
    sums = counted.join(branch, ["host", "template"]).groupBy("host", "branch").agg(_smoothed(F.sum("b"), F.sum("n"), F.lit(prior), weight).alias("score"))
    tree = staged(branch.join(sums, ["host", "branch"]), "url_scores")
    judged = shaped.select("host", "path", "template").join(tree, ["host", "template"], "left")
    joined = parsed.join(judged, ["host", "path"])
    by_tree = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_tree).alias("verdict"), "template", "branch",
        F.round("score", 9).alias("score"),
    )
