"""URL filter by rules and, where no rule speaks, by trust that flows over links between hosts.

Pages are judged by (host, path) rules first; the longest rule that fits wins. For the others two
scores are propagated over the host graph: personalised PageRank from trusted seeds along the
links, and distrust from blocked seeds against them (who links to bad hosts is suspect). A host is
blocked where distrust makes up at least ``threshold`` of the two scores.

Seeds are hosts of which at least half the pages are allowed (trusted) or blocked by a rule.

Defined results: a null url, or one without "://", has empty host and path, fits no rule and is
allowed by the method; hosts that no seed reaches are allowed. Null pages have no links; very long ones
are read whole; an empty table gives no rows. Links of a
host to itself carry no judgement and are left out; repeated rows weigh as often as they occur.
Between rules of one length the greater rule string wins. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.session import written

#: The dealt rules (rule string, verdict).
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
DAMPING = 0.85
ROUNDS_PER_WRITE = 5
TOLERANCE = 1e-6
THRESHOLD = 0.5
SEED_SHARE = 0.5
#: Links with a scheme, or none of their own but a host.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def lower_ascii(text: F.Column) -> F.Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: F.Column) -> F.Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: F.Column) -> F.Column:
    host = F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit(""))


def path_of(url: F.Column) -> F.Column:
    path = F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """rule, rule_host, rule_path, verdict."""
    df = spark.createDataFrame([(r, v) for r, v in rules], "rule string, verdict string")
    return df.select(
        "rule",
        F.substring_index("rule", "/", 1).alias("rule_host"),
        F.regexp_extract("rule", "^[^/]*(/.*)$", 1).alias("rule_path"),
        "verdict",
    )


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host with ``rules``: all rules that fit it or one of its parent domains."""
    labels = F.split("host", "\\.")
    suffix = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    return (
        hosts.select("host", F.explode(suffix).alias("rule_host"))
        .join(rules, "rule_host")
        .groupBy("host")
        .agg(
            F.collect_list(
                F.struct(F.length("rule").alias("size"), "rule", "rule_path", "verdict")
            ).alias("rules")
        )
    )


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, links: links between different hosts, counted before the shuffle."""
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))
    return (
        pages.select(host_of(F.col("url")).alias("src"), F.explode(links).alias("link"))
        # a link without a scheme has that of its page; the host is found behind any
        .select("src", host_of(F.concat(F.when(F.col("link").startswith("//"), ":").otherwise(""), "link")).alias("dst"))
        .filter("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("links"))
    )


def propagate(
    seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """kind, host, score from seeds (kind, host, seed) over edges (kind, src, dst, share).

    Shares of one source sum to one. Mass of hosts without links is lost, which scales the scores
    only. Rounds go on until no score moves by more than the tolerance, which the damping brings about:
    what moves in all shrinks by it each round.
    """
    start = seeds.select("kind", "host", ((1 - damping) * F.col("seed")).alias("base"))
    scores = start.select("kind", "host", F.col("base").alias("score"))
    while True:
        for _ in range(ROUNDS_PER_WRITE):
            old = scores
            flow = old.withColumnRenamed("host", "src").join(edges, ["kind", "src"]).select(
                "kind", F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("score")
            )
            scores = (
                flow.unionByName(start.withColumnRenamed("base", "score"))
                .groupBy("kind", "host")
                .agg(F.sum("score").alias("score"))
            )
        # the last two rounds go into one table, so that they are compared without being made again
        both = scores.join(old.withColumnRenamed("score", "old"), ["kind", "host"], "left")
        both = written(both.withColumn("moved", F.abs(F.col("score") - F.coalesce("old", F.lit(0.0)))), "host-scores")
        scores = both.select("kind", "host", "score")
        if (both.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            return scores


def judged_pages(
    pages: DataFrame, rules: DataFrame | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust."""
    rules = rules_table(pages.sparkSession) if rules is None else rules
    placed = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    hosts = placed.groupBy("host").agg(F.count("*").alias("n_pages"))
    # written, like the scores below, so that the joins are between plain shuffles, which large
    # hosts can be split in
    fitting = written(host_rules(hosts, rules), "rules-of-hosts")
    best = F.array_max(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])))
    judged = (
        placed.join(fitting, "host", "left")
        .withColumn("_best", best)
        .select(
            "page_id",
            "host",
            "path",
            F.col("_best.rule").alias("rule"),
            F.col("_best.verdict").alias("by_rule"),
        )
    )
    judged = written(judged, "judged-pages")

    share = lambda verdict: F.count_if(F.col("by_rule") == verdict) / F.count("*")
    known = judged.filter("host <> ''").groupBy("host").agg(
        share("allow").alias("allow"), share("block").alias("block")
    )
    kinds = F.array(
        F.when(F.col("allow") >= SEED_SHARE, F.lit("trust")),
        F.when(F.col("block") >= SEED_SHARE, F.lit("distrust")),
    )
    seeds = known.select("host", F.explode(F.array_compact(kinds)).alias("kind"), F.lit(1.0).alias("seed"))
    seeds = written(seeds, "host-seeds")

    links = written(host_edges(pages), "host-links")
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    )
    total = both.groupBy("kind", "src").agg(F.sum("links").alias("total"))
    edges = both.join(total, ["kind", "src"]).select(
        "kind", "src", "dst", (F.col("links") / F.col("total")).alias("share")
    )
    scores = propagate(seeds, written(edges, "host-edges"))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    by_host = scores.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
    by_host = written(by_host, "scores-of-hosts")
    suspect = F.col("distrust") >= threshold * (F.col("trust") + F.col("distrust"))
    by_method = F.when((F.col("distrust") > 0) & suspect, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(by_host, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", by_method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
