"""URL rules, and trust and distrust of hosts propagated over the link graph."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.storage import Store

#: (host, path, verdict): fixed values.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DAMPING = 0.85
#: Share of all seeds that a step may still pass on at the end.
TOLERANCE = 1e-6
STEPS_PER_TABLE = 4
BLOCK_FROM = 0.5
LINK = r"""(?i)<(?:a|area|link|iframe)\s[^>]*?(?:href|src)\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Host after the first ``://`` in lower case; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def judge_urls(
    pages: DataFrame,
    store: Store,
    rules: Sequence[tuple[str, str, str]] = RULES,
    damping: float = DAMPING,
    block_from: float = BLOCK_FROM,
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every row of ``pages``.

    A page that a rule fits has the rule's verdict. The others have their host's: the share of a host's
    pages that rules allow (block) is its seed of trust (distrust). Trust follows the links between
    hosts, distrust goes against them, both by personalised PageRank whose restart gives an unlinked
    host its seed. A host whose distrust exceeds its trust by ``block_from`` is blocked.

    Links are absolute or protocol-relative addresses in the page's tags; links within a host and
    repeated links between two hosts do not count. Hosts are grouped before anything is joined, so a
    host may hold any share of the pages. A null url or one without ``://`` has empty host and path, no
    rule and the verdict ``allow``; null html has no links; equal rows are judged alike; an empty table
    gives no rows.
    """
    url = F.col("url")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    judged = store.keep(judged.withColumns({"rule": name, "_says": verdict}), "url-rules")
    hosts = judged.filter("host <> ''").groupBy("host").agg(
        (F.count_if(F.col("_says") == "allow") / F.count(F.lit(1))).alias("trust"),
        (F.count_if(F.col("_says") == "block") / F.count(F.lit(1))).alias("distrust"),
    )
    hosts = store.keep(hosts, "url-hosts")
    target = host_of(F.concat(F.lit("x:"), F.regexp_replace("link", r"(?i)^https?:", "")))
    links = (
        pages.select(host_of(url).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link"))
        .select("src", target.alias("dst"))
        .filter("src <> '' AND dst <> '' AND src <> dst")
        .distinct()
    )
    links = store.keep(links, "url-links")
    trust = propagate(hosts.select("host", F.col("trust").alias("seed")), links, store, "trust", damping)
    against = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    distrust = propagate(hosts.select("host", F.col("distrust").alias("seed")), against, store, "distrust", damping)
    scores = (
        trust.withColumnRenamed("score", "trust")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "full")
        .na.fill(0.0)
        .withColumn("_host_verdict", F.when(F.col("distrust") - F.col("trust") >= block_from, "block").otherwise("allow"))
    )
    # Adaptive execution splits hot hosts here, or sends the table of hosts while it is small.
    scores = store.keep(scores, "url-scores")
    return judged.join(scores, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("_says", "_host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def propagate(seeds: DataFrame, links: DataFrame, store: Store, name: str, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank: seed + damping * what the linking hosts pass on, to convergence.

    A host passes its score on in equal parts; hosts that are only linked to have seed 0. The sum of
    the steps is kept per host; every few steps it is written, which cuts the lineage. Steps go on until one
    passes on at most ``TOLERANCE`` of the seeds' total. No step passes on more than ``damping`` of what the
    one before did, so that takes a number of steps that depends on these two alone: 86 at most as they are.
    """
    if not 0 <= damping < 1:
        raise ValueError("damping must be at least 0 and below 1")
    degree = links.groupBy("src").agg(F.count(F.lit(1)).alias("_out"))
    edges = store.keep(links.join(degree, "src").select("src", "dst", (damping / F.col("_out")).alias("part")), f"{name}-edges")
    score = seeds.select("host", F.col("seed").alias("score"))
    wave, kept = seeds.filter("seed > 0").select("host", F.col("seed").alias("amount")), []
    total, step = score, 0
    seeded = seeds.agg(F.sum("seed")).first()[0] or 0.0
    while True:
        step += 1
        passed = wave.join(edges, F.col("host") == F.col("src")).groupBy("dst").agg(F.sum(F.col("amount") * F.col("part")).alias("amount"))
        wave = store.keep(passed.select(F.col("dst").alias("host"), "amount"), f"{name}-{step}")
        kept.append(wave)
        if (wave.agg(F.sum("amount")).first()[0] or 0.0) <= TOLERANCE * seeded:
            break
        if len(kept) == STEPS_PER_TABLE:
            total = store.keep(_summed(total, kept), f"{name}-total-{step}")
            kept = []
    return _summed(total, kept)


def _summed(total: DataFrame, waves: list[DataFrame]) -> DataFrame:
    parts = reduce(DataFrame.unionByName, [w.select("host", F.col("amount").alias("score")) for w in waves], total)
    return parts.groupBy("host").agg(F.sum("score").alias("score"))
