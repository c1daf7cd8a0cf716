"""URL filter: rules first, then the link graph.

A rule (host and path prefix, allow or block) fits its host and all subdomains
where the path starts with the rule's; the longest rule that fits decides.  URLs
without a rule get their host's verdict: trust flows along links from hosts with
allowed pages (personalised PageRank), distrust flows against links from hosts
with blocked pages, and a host is blocked when its distrust exceeds its trust
by ``threshold``.

Only DataFrame operations.  Host edges are aggregated before the first round, so
a round costs as much as there are pairs of linked hosts; scores are written to
the shared folder every few rounds, which cuts the lineage.  There are as many
rounds as it takes until no host is newly reached and no score still changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import drop_table, pick, write_table

#: (host, path prefix, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
DAMPING = 0.85
ROUNDS_A_TABLE = 4
#: Largest change of a host's score from one table to the next, as a share of its score, that counts as none.
TOLERANCE = 1e-6
THRESHOLD = 0.0
LINK = r"(?i)\bhref\s*=\s*[\"']?((?:https?:)?//[^\s\"'<>]+)"
A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null and without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), *A_TO_Z)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty like the host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and all domains above it, by whole labels."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))


def with_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``hosts`` (host) with ``rules``: those that fit the host, longest
    first.  Many rules are a join on the domain, not a scan per host."""
    above = hosts.select("host", F.explode(suffixes(F.col("host"))).alias("rule_host"))
    fits = (above.join(rules, "rule_host").groupBy("host").agg(F.collect_set(F.struct(
        (-F.length("rule_host") - F.length("rule_path")).alias("order"), "rule_host", "rule_path", "rule_verdict"))
        .alias("rules")))
    return hosts.join(fits, "host", "left").select("host", F.array_sort("rules").alias("rules"))


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame([(h, p, v) for h, p, v in rules],
                                 "rule_host string, rule_path string, rule_verdict string").dropDuplicates(
                                     ["rule_host", "rule_path"])


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links of each host to other hosts, from (host, html);
    relative links stay on the host and say nothing about others."""
    links = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    target = F.translate(F.regexp_extract(F.col("url"), r"//([^/?#]*)", 1), *A_TO_Z)
    return (pages.where("html is not null and host != ''").select(F.col("host").alias("src"), links.alias("url"))
            .select("src", target.alias("dst")).where("dst != '' and src != dst")
            .groupBy("src", "dst").agg(F.count("*").alias("n")))


def propagate(edges: DataFrame, seeds: DataFrame, name: str, tolerance: float = TOLERANCE,
              damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank: (host, score) from ``seeds`` (host, seed; adding
    up to 1) along ``edges`` (src, dst, n).  A host without links keeps no
    flow; the rest of its score returns by the seeds in the next round.

    Rounds go on until no host's score changes by more than ``tolerance`` of
    itself; a newly reached host changes by all of its score, so chains are
    followed to their end.  Scores start low and only grow, the change as a
    whole by a factor of ``damping`` less a round, so this comes to an end.
    """
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    share = write_table(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share")),
                        f"links-{name}")
    base = write_table(seeds.select("host", (F.col("seed") * (1 - damping)).alias("score")), f"seeds-{name}")
    if share.isEmpty():
        return base
    last = base
    while True:
        scores = last
        for _ in range(ROUNDS_A_TABLE):
            flow = (share.join(scores, share["src"] == scores["host"]).groupBy(F.col("dst").alias("host"))
                    .agg(F.sum(F.col("share") * F.col("score") * damping).alias("score")))
            scores = flow.unionByName(base).groupBy("host").agg(F.sum("score").alias("score"))
        scores = write_table(scores, f"scores-{name}")
        before = last.select("host", F.col("score").alias("before"))
        change = F.abs(F.col("score") - F.coalesce("before", F.lit(0.0)))
        settled = scores.join(before, "host", "left").where(change > tolerance * F.col("score")).isEmpty()
        if last is not base:
            drop_table(last)
        if settled:
            return scores
        last = scores


def _seeds(judged: DataFrame, verdict: str) -> DataFrame:
    """Hosts with pages of that verdict by rule, each weighed by its share of
    such pages among its own.  The weight of one host doesn't depend on how
    many other seeds there are, so trust and distrust can be compared."""
    share = F.avg(F.when(F.col("rule_verdict") == verdict, 1.0).otherwise(0.0))
    return (judged.where("host != ''").groupBy("host").agg(share.alias("seed")).where("seed > 0")
            .select("host", "seed"))


def judge_urls(pages: DataFrame, rules=RULES, url: str = "url", html: str = "html", page_id: str = "page_id",
               threshold: float = THRESHOLD) -> DataFrame:
    """One row per page: page_id, host, path, rule (host and path prefix of the
    deciding rule, else null), verdict (allow or block), trust and distrust of
    the host.

    ``rules`` is a list of (host, path, verdict) or a DataFrame (rule_host,
    rule_path, rule_verdict).  A null URL or one without ``://`` has an empty
    host and path, fits no rule and is allowed, like hosts that neither trust
    nor distrust reaches.  Repeated pages are judged alike.
    """
    spark = pages.sparkSession
    rules = rules if isinstance(rules, DataFrame) else rule_table(spark, rules)
    rows = pick(pages, page_id=page_id, url=url, html=html).withColumn("host", host_of(F.col("url"))).withColumn(
        "path", path_of(F.col("url")))
    narrow = rows.select("page_id", "host", "path")
    # Read back, so that the join below deals both sides anew and a hot host's pages can be split.
    hosts = write_table(with_rules(narrow.select("host").distinct(), rules), "url-rules")
    best = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])), 0)
    judged = write_table(narrow.join(hosts, "host", "left").withColumn("best", best).select(
        "page_id", "host", "path", F.concat("best.rule_host", "best.rule_path").alias("rule"),
        F.col("best.rule_verdict").alias("rule_verdict")), "url-judged")
    edges = write_table(link_edges(rows.select("host", "html")), "url-links")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    trust = propagate(edges, _seeds(judged, "allow"), "trust").withColumnRenamed("score", "trust")
    distrust = propagate(back, _seeds(judged, "block"), "distrust").withColumnRenamed("score", "distrust")
    scores = trust.join(distrust, "host", "full").select(
        "host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    host_verdict = F.when(zero("distrust") - zero("trust") > threshold, "block").otherwise("allow")
    return judged.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", host_verdict).alias("verdict"),
        zero("trust").alias("trust"), zero("distrust").alias("distrust"))
