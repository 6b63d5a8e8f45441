"""URL filter by rules and by trust that flows along links between hosts.

A rule names a host and the start of a path; it fits the host and its subdomains, and the longest fitting rule decides.
Hosts of pages that a rule allows are seeds of trust, those of blocked pages seeds of distrust, by their number of such
pages. Trust follows links, distrust goes against them, to hosts that link to distrusted ones: two personalised
PageRanks over the same host edges. A page without a rule is blocked if its host has more distrust than trust times
``THRESHOLD`` and than ``FLOOR``, else allowed; hosts that neither reaches are allowed.

What flows is the mass that has just arrived: each iteration joins it with the edges and adds it up before the shuffle, so hosts
with many links are split. It shrinks by the damping each time, and the iterations end when no host gets more than
``TOLERANCE``, however many that takes: with damping 0.8 a chain of links is followed for about a hundred hosts, until what
arrives is below the floor. Each ``CHECKPOINT`` iterations what flows and the scores are written to the shared folder. Mass that
reaches a host without links onward ends there.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed; null html has no
links; links within a host do not count; repeated pages count and are judged as often as they occur; an empty table
gives no rows. Of rules of equal length a blocking one wins. Other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.session import staged

DAMPING, CHECKPOINT = 0.8, 3
#: Arriving mass at which the iterations end, and the score below which a host counts as not reached.
TOLERANCE, FLOOR = 1e-11, 1e-9
THRESHOLD = 1.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


RULES = [Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"),
         Rule("org", "/fr/", "allow")]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def link_hosts(html: Column) -> Column:
    """Distinct hosts of absolute links."""
    links = F.regexp_extract_all(html, F.lit(r"""(?i)\shref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""), F.lit(1))
    return F.array_distinct(F.transform(F.coalesce(links, F.array().cast("array<string>")),
                                        lambda h: F.translate(h, UPPER, LOWER)))


def parsed(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Host, path and hosts linked to of every page, staged with a row number; the html is read here only."""
    return staged(pages.select(
        F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"), link_hosts(F.col(html)).alias("links")), "trust-pages")


def ruled(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """Row, rule and verdict of the pages that a rule fits."""
    table = pages.sparkSession.createDataFrame(
        [(r.host, r.path, r.verdict) for r in rules], "rule_host string, rule_path string, rule_verdict string")
    labels = F.split("host", r"\.")
    suffixes = pages.where("host <> ''").select("row", "path", labels.alias("labels")).select(
        "row", "path", F.explode(F.transform(
            F.sequence(F.lit(1), F.size("labels")),
            lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))).alias("rule_host"))
    best = F.max(F.struct(F.length(F.concat("rule_host", "rule_path")).alias("n"), (F.col("rule_verdict") == "block").alias("block"),
                          F.concat("rule_host", "rule_path").alias("rule")))
    return (suffixes.join(table, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
            .groupBy("row").agg(best.alias("best"))
            .select("row", "best.rule", F.when(F.col("best.block"), "block").otherwise("allow").alias("ruling")))


def host_edges(pages: DataFrame) -> DataFrame:
    """Pages of a host that link to another host."""
    return (pages.where("host <> ''").select("host", F.explode("links").alias("to")).where("to <> host")
            .groupBy("host", "to").agg(F.count("*").cast("double").alias("n")))


def propagated(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Scores by kind and host from ``seeds`` (kind, host, seed), each kind summing to 1, over ``edges`` (host, to, n)."""
    out, into = edges.groupBy("host").agg(F.sum("n").alias("all")), edges.groupBy("to").agg(F.sum("n").alias("all"))
    steps = staged(
        edges.join(out, "host").select(F.lit("trust").alias("kind"), "host", "to", (F.col("n") / F.col("all")).alias("share"))
        .unionByName(edges.join(into, "to").select(
            F.lit("distrust").alias("kind"), F.col("to").alias("host"), F.col("host").alias("to"),
            (F.col("n") / F.col("all")).alias("share"))), "trust-steps")
    arrived = staged(seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("score")), "trust-base")
    if steps.isEmpty():
        return arrived  # nothing flows: only the seeds keep their share
    scores = arrived
    while not arrived.where(F.col("score") > tolerance).isEmpty():
        rounds = []
        for _ in range(CHECKPOINT):
            arrived = (arrived.join(steps, ["kind", "host"]).groupBy("kind", F.col("to").alias("host"))
                       .agg((F.sum(F.col("score") * F.col("share")) * damping).alias("score")))
            rounds.append(arrived)
        # The rounds since the last writing, told apart by number, are written together.
        lines = rounds[0].withColumn("round", F.lit(0))
        for i, more in enumerate(rounds[1:], 1):
            lines = lines.unionByName(more.withColumn("round", F.lit(i)))
        lines = staged(lines, "trust-rounds")
        arrived = lines.where(F.col("round") == CHECKPOINT - 1).drop("round")
        scores = staged(scores.unionByName(lines.drop("round")).groupBy("kind", "host").agg(F.sum("score").alias("score")), "trust-scores")
    return scores


def judge(pages: DataFrame, rules: list[Rule] | None = None, threshold: float = THRESHOLD, key: str = "page_id",
          url: str = "url", html: str = "html") -> DataFrame:
    """Per page: key, host, path, rule (or null), trust and distrust of its host, and verdict."""
    found = parsed(pages, key, url, html)
    by_rule = staged(found.select("row", "host").join(ruled(found, RULES if rules is None else rules), "row"), "trust-ruled")
    counted = by_rule.groupBy("host", "ruling").agg(F.count("*").alias("n"))
    totals = counted.groupBy("ruling").agg(F.sum("n").alias("all"))
    kind = F.when(F.col("ruling") == "allow", "trust").otherwise("distrust").alias("kind")
    seeds = staged(counted.join(totals, "ruling").select(kind, "host", (F.col("n") / F.col("all")).alias("seed")), "trust-seeds")
    scores = propagated(seeds, host_edges(found)).groupBy("host").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(k) for k in ("trust", "distrust")])
    by_host = F.when((F.col("distrust") > F.col("trust") * threshold) & (F.col("distrust") > FLOOR), "block").otherwise("allow")
    return (found.drop("links").join(by_rule.drop("host"), "row", "left").join(scores, "host", "left")
            .fillna(0.0, ["trust", "distrust"])
            .select(F.col("key").alias(key), "host", "path", "rule", "trust", "distrust",
                    F.coalesce("ruling", by_host).alias("verdict")))
