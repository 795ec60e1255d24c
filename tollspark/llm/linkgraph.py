"""URL filter: rules first, and where none fits, trust and distrust propagated over the links between hosts.

Rules. A rule is an action with a host and a path prefix. It fits its host and all subdomains of it where the path of the
url starts with its path. The longest fitting rule wins (characters of host and path; then the longer host; then `block`).
Rules are joined by the last one, two, ... labels of the host, as many as the longest rule host has, so that a page is
never compared with rules of other hosts and never multiplied.

Graph. Hosts link by the `href` of `a` elements that lead to another host by http, https or a protocol-relative url
(comments, scripts and styles left out). The weight of an edge is the number of pages of the source host that have such
a link. A host is a trusted seed by the share of its pages that a rule allows, and a blocked seed by the share blocked.
Trust flows from trusted seeds along the edges (personalised PageRank), distrust from blocked seeds against them. Each
round sends `damping` of the mass received in the round before; mass at hosts without edges is lost, which equals a
return to the seeds up to the scale, and both kinds are scaled to a sum of 1. Masses are whole numbers, so that sums
don't depend on their order and reruns agree. What `rounds` rounds leave out is damping ** (rounds + 1) at most.

A host's score is trust / (trust + distrust); it is allowed from `threshold` on. Hosts that neither reaches get
`otherwise`.

Null urls and urls without `://` have an empty host and path, no rule, no edges and the verdict `otherwise`. Null html has
no links. Repeated rows are judged alike, and count as pages. An empty table gives an empty result. Without rules every
verdict is `otherwise`. Names of other columns can't clash: only those of `keep` are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollspark.llm.common import LOWER, UPPER, staged
from tollspark.session import shared_folder

#: Mass of all seeds of a kind: whole units, small enough for doubles to hold them exactly.
UNIT = 10 ** 15

_HIDDEN = r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)"
_LINK = r"""(?is)<a\s[^<>]*?\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]*)"""


def host_of(url: Column) -> Column:
    """What is between the first `://` and `/`, `?`, `#` or the end, with A-Z lower-cased; empty without `://`."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rows (host, path, action, rule) of rules (action, text); the host ends at the first slash of the text."""
    rows = []
    for action, text in rules:
        host, slash, path = text.partition("/")
        if action not in ("allow", "block"):
            raise ValueError(f"neither allow nor block: {action}")
        rows.append((host.translate(str.maketrans(UPPER, LOWER)), slash + path, action, text))
    return spark.createDataFrame(rows, "host string, path string, action string, rule string")


def with_rules(pages: DataFrame, rules: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` with `host`, `path` and the winning `rule` and `action`, both null where none fits."""
    kept = F.struct(*keep).alias("kept")
    found = pages.select(kept, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # One row per rule host: joining it can't multiply pages.
    per_host = rules.groupBy(F.col("host").alias("of")).agg(F.collect_set(F.struct(
        (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"), "action", "rule",
        "path")).alias("rules"))
    labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    nothing = F.array().cast(per_host.schema["rules"].dataType)
    found = found.withColumn("fits", nothing)
    for n in range(1, labels + 1):
        found = found.join(per_host, F.substring_index("host", ".", -n) == F.col("of"), "left").select(
            "kept", "host", "path", F.concat("fits", F.coalesce(F.filter(
                "rules", lambda rule: F.startswith(F.col("path"), rule.path)), nothing)).alias("fits"))
    best = F.array_max("fits")
    return found.select("kept", "host", "path", best.rule.alias("rule"), best.action.alias("action"))


def links(pages: DataFrame) -> DataFrame:
    """Edges (source, target, weight) between different hosts of `pages` (url, html)."""
    targets = F.regexp_extract_all(F.regexp_replace("html", _HIDDEN, " "), F.lit(_LINK), F.lit(1))
    lower = F.transform(targets, lambda host: F.translate(host, UPPER, LOWER))
    return pages.where("url is not null and html is not null") \
        .select(host_of(F.col("url")).alias("source"), F.explode(F.array_distinct(lower)).alias("target")) \
        .where("source <> '' and target <> '' and source <> target") \
        .groupBy("source", "target").agg(F.count("*").alias("weight"))


def _flows(edges: DataFrame) -> DataFrame:
    """Edges of both kinds with the share of the mass of `giver` that they carry: trust forward, distrust backward."""
    ways = edges.select(F.lit("trust").alias("kind"), F.col("source").alias("giver"), F.col("target").alias("taker"),
                        "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("giver"), F.col("source").alias("taker"),
                     "weight"))
    # Sums by aggregate and join, not by window, as a hub's edges needn't meet in one task.
    total = ways.groupBy("kind", "giver").agg(F.sum("weight").alias("total"))
    return ways.join(total, ["kind", "giver"]).select("kind", "giver", "taker", (F.col("weight") / F.col("total")).alias("share"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 40) -> DataFrame:
    """Mass (kind, host, mass) after `rounds` rounds, from `seeds` of the same columns and `edges` (source, target, weight).
    Each round is written, so that a lost executor costs no earlier one; it ends early where no mass is left to send."""
    spark, folder = seeds.sparkSession, shared_folder(seeds.sparkSession, "mass")
    flows, sent, paths = staged(_flows(edges), "flows"), seeds.select("kind", "host", "mass"), []
    for n in range(rounds + 1):
        sent.write.parquet(f"{folder}/{n}")
        sent = spark.read.schema(sent.schema).parquet(f"{folder}/{n}")
        if sent.isEmpty():
            break
        paths.append(f"{folder}/{n}")
        sent = flows.join(sent.withColumnRenamed("host", "giver"), ["kind", "giver"]) \
            .groupBy("kind", F.col("taker").alias("host")) \
            .agg(F.sum(F.floor(F.col("mass") * F.col("share") * damping)).alias("mass")).where("mass > 0")
    reached = spark.read.schema(seeds.schema).parquet(*paths) if paths else sent
    return reached.groupBy("kind", "host").agg(F.sum("mass").alias("mass"))


def host_scores(judged: DataFrame, edges: DataFrame, **settings) -> DataFrame:
    """Rows (host, score) of all hosts that trust or distrust reaches, from pages with their `host` and `action`."""
    hosts = judged.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("action") == "allow").alias("allowed"),
        F.count_if(F.col("action") == "block").alias("blocked"))
    shares = staged(hosts.where("allowed + blocked > 0").select(
        "host", F.floor(F.col("allowed") * 1_000_000 / F.col("pages")).alias("trust"),
        F.floor(F.col("blocked") * 1_000_000 / F.col("pages")).alias("distrust")), "seeds")
    sums = shares.agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).first()
    seeds = None
    for kind in ("trust", "distrust"):
        one = shares.where(F.col(kind) > 0).select(F.lit(kind).alias("kind"), "host", F.floor(
            F.col(kind) * (UNIT / (sums[kind] or 1))).alias("mass"))
        seeds = one if seeds is None else seeds.unionByName(one)
    mass = staged(propagate(seeds, edges, **settings), "reached")
    total = {row.kind: row.total for row in mass.groupBy("kind").agg(F.sum("mass").alias("total")).collect()}
    of = {kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0)) / float(total.get(kind, 1))
          for kind in ("trust", "distrust")}
    return mass.groupBy("host").agg(of["trust"].alias("trust"), of["distrust"].alias("distrust")) \
        .where("trust + distrust > 0").select("host", (F.col("trust") / (F.col("trust") + F.col("distrust"))).alias("score"))


def judge(pages: DataFrame, rules: DataFrame, keep: list[str], threshold: float = 0.5, otherwise: str = "allow",
          **settings) -> DataFrame:
    """The columns `keep` of every row of `pages` (url, html) with `host`, `path`, `rule`, `verdict` and the host's
    `score` (null where nothing reaches it). `settings` are those of `propagate`."""
    judged = with_rules(pages, rules, keep)
    scores = staged(host_scores(judged, links(pages), **settings), "scores")
    by_graph = F.when(F.col("score") >= threshold, "allow").when(F.col("score").isNotNull(), "block").otherwise(otherwise)
    return judged.join(scores, "host", "left").select(
        "kept.*", "host", "path", "rule", F.coalesce("action", by_graph).alias("verdict"), "score")
