"""URL filters: fixed rules first, and a path-template tree learned from labelled pages for the rest.

Each host has a tree of path segments. Numbers and long ids are wildcards by their form; below each
node, segments that only one address or too small a share of them has are one wildcard as well.
Branches whose labelled pages cannot be told apart by a two-proportion test are merged, the tree
goes on below the merged branch, and what a path becomes is its template. The share of good pages
of a template is shrunk towards its host's, and that towards that of all pages; templates below
the limit are rejected.

The tree grows level by level over distinct path shapes, which are folded in each task first. A node
keeps at most 33 branches when they are put side by side, however many segments it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relocate.session import settle

#: Verdict, and host with the start of the path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ALLOW, BLOCK = "allow", "block"
WILD, REST = "*", "**"


@dataclass(frozen=True)
class Tree:
    """``depth`` segments have nodes of their own, what is deeper is one wildcard; a literal branch has
    at least one in ``branches`` of its node's addresses; ``similar`` is the squared z up to which
    branches are alike; ``prior`` is the weight of the rate above; ``limit`` the least purity."""

    depth: int = 8
    branches: int = 32
    similar: float = 3.84
    prior: float = 5.0
    limit: float = 0.7


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Struct ``length, rule, verdict`` of the longest rule that fits, else null; of equals the last by name."""
    fits = []
    for verdict, rule in rules:
        name, slash, start = rule.partition("/")
        whose = (host == name) | F.endswith(host, F.lit("." + name))
        fit = F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fits.append(F.when(whose & F.startswith(path, F.lit(slash + start)), fit))
    return F.array_max(F.array(*fits))


def shape_of(path: Column, depth: int) -> Column:
    """The path with numbers and long ids as wildcards, and one wildcard for what lies too deep."""
    form = lambda s: F.when(s.rlike(r"\A[0-9A-Fa-f-]{16,}\z"), "{id}").otherwise(
        F.regexp_replace(s, "[0-9]+", "{n}")
    )
    parts = F.transform(F.split(path, "/", -1), form)
    deep = F.concat(F.slice(parts, 1, depth + 1), F.array(F.lit(REST)))
    return F.array_join(F.when(F.size(parts) > depth + 1, deep).otherwise(parts), "/")


def shapes(pages: DataFrame, labels: DataFrame, tree: Tree) -> DataFrame:
    """``host, shape, n, m, g``: addresses, labelled pages and good ones of every path shape.

    A page is labelled by the row of its id; of several labels the worst counts, null ones do not.
    """
    known = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").cast("long").alias("_good"))
    url = F.col("url").cast("string")
    rows = pages.select(
        F.col("page_id").cast("long").alias("_id"), host_of(url).alias("host"), shape_of(path_of(url), tree.depth).alias("shape")
    )
    return (
        rows.join(known.filter(F.col("_id").isNotNull()), "_id", "left")
        .groupBy("host", "shape")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("_good").alias("m"),
            F.coalesce(F.sum("_good"), F.lit(0).cast("long")).alias("g"),
        )
    )


def _alike(a: Column, b: Column, limit: float) -> Column:
    """Whether the squared z of two shares of good pages is within the limit; always without labels."""
    gap = (a["g"] * b["m"] - b["g"] * a["m"]).cast("double")
    all_m, all_g = (a["m"] + b["m"]).cast("double"), (a["g"] + b["g"]).cast("double")
    spread = a["m"].cast("double") * b["m"].cast("double") * all_g * (all_m - all_g)
    return gap * gap * all_m <= spread * limit


def _merged(branches: Column, limit: float) -> Column:
    """Tokens in order of their rates with the number of their cluster, neighbours merged while alike."""
    none = F.array().cast("array<struct<token:string,cluster:int>>")
    zero = F.lit(0).cast("long")
    begin = F.struct(zero.alias("m"), zero.alias("g"), F.lit(0).alias("cluster"), none.alias("told"))

    def step(acc: Column, x: Column) -> Column:
        same = _alike(acc, x, limit)
        cluster = F.when(same, acc["cluster"]).otherwise(acc["cluster"] + 1)
        told = F.array(F.struct(x["token"].alias("token"), cluster.alias("cluster")))
        held = [F.when(same, acc[c] + x[c]).otherwise(x[c]).alias(c) for c in ("m", "g")]
        return F.struct(*held, cluster.alias("cluster"), F.concat(acc["told"], told).alias("told"))

    return F.aggregate(branches, begin, step, lambda acc: acc["told"])


def _grown(rows: DataFrame, level: int, tree: Tree) -> DataFrame:
    """The rows with the segment of one level added to ``prefix``, generalised and merged."""
    node = ["host", "prefix"]
    cut = rows.withColumn("seg", F.get(F.split("shape", "/", -1), F.lit(level)))
    sums = [F.sum(c).alias(c) for c in ("n", "m", "g")]
    children = settle(cut.filter(F.col("seg").isNotNull()).groupBy(*node, "seg").agg(*sums), "children")
    nodes = children.groupBy(*node).agg(
        F.count(F.lit(1)).alias("kinds"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "m", "g")]
    )
    rare = (F.col("n") < 2) | (F.col("n") * tree.branches < F.col("all_n"))
    token = F.when((F.col("kinds") > 1) & rare, WILD).otherwise(F.col("seg"))
    told = settle(children.join(nodes, node).withColumn("token", token), "tokens")
    above = F.when(F.col("all_m") > 0, F.col("all_g") / F.col("all_m")).otherwise(0.5)
    rate = (F.col("g") + above * tree.prior) / (F.col("m") + tree.prior)
    folded = told.groupBy(*node, "token", "all_m", "all_g").agg(F.sum("m").alias("m"), F.sum("g").alias("g"))
    branches = folded.groupBy(*node).agg(
        F.sort_array(F.collect_list(F.struct(rate.alias("rate"), "token", "m", "g"))).alias("branches")
    )
    merged = branches.select(*node, _merged(F.col("branches"), tree.similar).alias("_told"))
    one = (F.size("_told") > 1) & (F.element_at("_told", -1)["cluster"] == 0)

    def named(x: Column) -> Column:
        mates = F.filter("_told", lambda y: y["cluster"] == x["cluster"])
        name = F.when(one, WILD).otherwise(F.array_join(F.array_sort(mates["token"]), "|"))
        return F.struct(x["token"].alias("token"), name.alias("name"))

    names = merged.select(*node, F.inline(F.transform("_told", named)))
    steps = settle(told.select(*node, "seg", "token").join(names, [*node, "token"]).drop("token"), "steps")
    grown = cut.join(steps, [*node, "seg"], "left")
    longer = F.when(F.col("name").isNull(), F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), "name"))
    return settle(grown.withColumn("prefix", longer).drop("seg", "name"), "grown")


def templates(pages: DataFrame, labels: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """``host, shape, template, pages, labelled, purity, verdict`` for every path shape of a host."""
    rows = settle(shapes(pages, labels, tree).withColumn("prefix", F.lit("")), "shapes")
    levels = rows.agg(F.max(F.size(F.split("shape", "/", -1)))).first()[0] or 0  # one number, at most depth + 2
    for level in range(1, levels):
        rows = _grown(rows, level, tree)
    sums = [F.sum(c).alias(c) for c in ("n", "m", "g")]
    found = settle(rows.groupBy("host", F.col("prefix").alias("template")).agg(*sums), "templates")
    hosts = found.groupBy("host").agg(F.sum("m").alias("host_m"), F.sum("g").alias("host_g"))
    share = found.agg(F.when(F.sum("m") > 0, F.sum("g") / F.sum("m")).otherwise(0.5)).scalar()
    host_rate = (F.col("host_g") + share * tree.prior) / (F.col("host_m") + tree.prior)
    purity = (F.col("g") + host_rate * tree.prior) / (F.col("m") + tree.prior)
    judged = found.join(hosts, "host").select(
        "host", "template", F.col("n").alias("pages"), F.col("m").alias("labelled"), purity.alias("purity")
    )
    judged = judged.withColumn("verdict", F.when(F.col("purity") >= tree.limit, ALLOW).otherwise(BLOCK))
    return rows.select("host", "shape", F.col("prefix").alias("template")).join(judged, ["host", "template"])


def judge(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES, tree: Tree = Tree()
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for every page.

    A rule's verdict goes before that of the template. Null addresses, and those without ``://``, have
    an empty host and path, whose template is judged like any other. Rows that repeat are judged each
    and count each; pages without an id have no label. Without any label a purity is a half. Other
    columns are not read.
    """
    found = settle(templates(pages, labels, tree), "verdicts").withColumnRenamed("verdict", "learned")
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumns({"shape": shape_of(F.col("path"), tree.depth), "_rule": rule_of(F.col("host"), F.col("path"), rules)})
    return rows.join(found, ["host", "shape"]).select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "learned").alias("verdict"),
        "template",
        "purity",
    )
