"""URL filter by link-graph propagation.

Rules judge a url outright.  Hosts of allowed pages seed *trust* and hosts of blocked pages seed
*distrust*, each in proportion to such pages.  Trust spreads along host edges and distrust against
them (a host that links to bad hosts is suspect), both as personalised PageRank: a share ``damping``
of a host's score flows on, the rest returns to the seeds.  A url that no rule fits is blocked where
its host's share of distrust in both scores exceeds ``threshold``.

Edges: links in the pages' html to other hosts, weighted by their count, and the edges between a
host and its parent domain (both ways), which tie subdomains together where pages link only inside
their own site.  Everything is DataFrame joins and aggregates; the pages are reduced to hosts and
distinct edges before the iterations, each of which is written to the shared scratch folder.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.session import Scratch

# The contract's rules as (host, path prefix, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DAMPING = 0.85
TOLERANCE = 1e-6
THRESHOLD = 0.5


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_match(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # a longer rule overrides a shorter one
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, html: str, host: str) -> DataFrame:
    """``(src, dst, n)``: counted links between different hosts, and both ways to the parent domain."""
    links = F.regexp_extract_all(F.col(f"`{html}`"), F.lit(r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""))
    own = F.col(f"`{host}`")
    linked = pages.where(F.col(f"`{html}`").contains("//") & (own != "")).select(
        own.alias("src"), F.explode(links).alias("dst")
    )
    linked = linked.select("src", lower_ascii(F.col("dst")).alias("dst")).where("src <> dst")
    linked = linked.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n"))
    hosts = pages.where(own != "").select(own.alias("h")).distinct()
    # parents of parents too: a.b.example.com -> b.example.com -> example.com; single labels have none
    labels = F.split("h", r"\.")
    chain = F.expr("transform(sequence(1, greatest(size(l) - 1, 1)), i -> array_join(slice(l, i, size(l)), '.'))")
    steps = hosts.withColumn("l", labels).where("size(l) > 2").withColumn("c", chain)
    pairs = steps.select(F.explode(F.arrays_zip(F.expr("slice(c, 1, size(c) - 1)").alias("src"),
                                                F.expr("slice(c, 2, size(c) - 1)").alias("dst"))).alias("e"))
    up = pairs.select("e.src", "e.dst").distinct()
    tree = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("n", F.lit(1.0))
    return linked.unionByName(tree).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def step_bound(damping: float = DAMPING, tolerance: float = TOLERANCE) -> int:
    """Steps after which trust and distrust together move less than ``tolerance``, whatever the graph:
    step k moves at most 2 damping^k of each."""
    return math.ceil(math.log(tolerance / 4) / math.log(damping)) + 1


def propagate(
    edges: DataFrame, seeds: DataFrame, scratch: Scratch, damping: float = DAMPING,
    iterations: int | None = None, tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(kind, host, score)``: personalised PageRank of every kind of seed over its own edges.

    ``edges``: kind, src, dst, n.  ``seeds``: kind, host, seed (summing to 1 per kind).  Stops when a
    step moves less than ``tolerance`` in all, which ``step_bound`` steps always reach; fewer
    ``iterations`` cut that off.
    """
    iterations = step_bound(damping, tolerance) if iterations is None else iterations
    out = edges.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    flows = scratch.stage(
        edges.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("total")).alias("share")),
        "flows",
    )
    seeds = scratch.stage(seeds, "seeds")
    score = seeds.select("kind", "host", F.col("seed").alias("score"))
    last = None
    for step in range(iterations):
        moved = flows.join(score, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (F.col("score") * F.col("share") * damping).alias("score"), F.lit(0.0).alias("old")
        )
        back = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("score"), F.lit(0.0).alias("old"))
        old = score.select("kind", "host", F.lit(0.0).alias("score"), F.col("score").alias("old"))
        new = moved.unionByName(back).unionByName(old).groupBy("kind", "host").agg(
            F.sum("score").alias("score"), F.sum("old").alias("old")
        )
        new = scratch.stage(new, f"step{step}")
        if last is not None:
            scratch.drop(last)
        last, score = new, new.select("kind", "host", "score")
        if (new.agg(F.sum(F.abs(F.col("score") - F.col("old")))).first()[0] or 0.0) < tolerance:
            break
    return score


def judge_urls(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules=RULES,
    damping: float = DAMPING, iterations: int | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per page: ``key``, host, path, rule, verdict, trust, distrust (its host's scores).

    A null url or one without ``://`` has an empty host and path, fits no rule and is allowed (no
    graph evidence); a null html has no links; repeated rows are judged alike and add to their
    host's seed weight; a host without any score is allowed; an empty table gives an empty result.
    Other columns are ignored.
    """
    address = F.col(f"`{url}`")
    with Scratch(pages.sparkSession, "urls") as scratch:
        judged = pages.select(
            F.col(f"`{key}`").alias("page_id"), F.col(f"`{html}`").alias("html"),
            url_host(address).alias("host"), url_path(address).alias("path"),
        )
        rule, verdict = rule_match(F.col("host"), F.col("path"), rules)
        judged = judged.withColumn("rule", rule).withColumn("ruled", verdict)
        edges = scratch.stage(host_edges(judged, "html", "host"), "edges")
        both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
            edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
        )
        kind = F.when(F.col("ruled") == "allow", "trust").otherwise("distrust")
        counts = judged.where("ruled is not null and host <> ''").groupBy(kind.alias("kind"), "host").agg(
            F.count(F.lit(1)).alias("n")
        )
        counts = scratch.stage(counts, "counts")
        totals = counts.groupBy("kind").agg(F.sum("n").alias("all"))  # two rows
        seeds = counts.join(F.broadcast(totals), "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("seed"))
        score = propagate(both, seeds, scratch, damping, iterations)
        hosts = score.groupBy("host").agg(
            F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
            F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
        )
        hosts = scratch.stage(hosts, "hosts", keep=True)
    trust, distrust = F.coalesce("s.trust", F.lit(0.0)), F.coalesce("s.distrust", F.lit(0.0))
    blocked = (distrust > 0) & (distrust > threshold * (trust + distrust))
    return judged.drop("html").alias("p").join(hosts.alias("s"), F.expr("p.host = s.host"), "left").select(
        "p.page_id", "p.host", "p.path", "p.rule",
        F.coalesce("p.ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
