"""URL filter: host rules first, then trust and distrust spread along the link graph.

Pages that a rule covers have the rule's verdict.  They also seed two scores of
their hosts: trust, a personalised PageRank from hosts by their allowed pages,
and distrust, a personalised PageRank from hosts by their blocked pages along
reversed links (who links to a blocked host is suspect).  A page without a
rule is blocked where its host's share of distrust passes the threshold.

Links are the absolute ``href`` targets (``//host/`` too) in the pages' html, counted by pairs of
hosts.  An iteration joins the scores with the edges and sums by host; sums
combine before the shuffle, so a host with very many links in is no hot key,
and one with many links out is split by Spark's skew-join handling.  Scores are
written to the shared folder every few iterations.  The mass of hosts without
links on is not handed on.

Rules: ``host/path`` covers the host and its subdomains where the url's path
starts with the rule's path; the longest rule wins (ties: by its text).

Defined results: null url or one without ``://``: empty host and path, no
rule, allowed; null html: no links; repeated rows: judged each, and counted
each; a table without links: only the seeds decide.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

#: (rule, verdict)
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
DAMPING = 0.85
#: Iterations go on until the scores' changes sum up to less than this; mass that moves on shrinks by the damping
#: in each, so it takes 114 of them at most (log SETTLED / log DAMPING).  More than the bound is an error.
SETTLED = 1e-8
MOST_ITERATIONS = 200
WRITE_EVERY = 5
#: A host is blocked when distrust makes up more than this share of its trust and distrust.
THRESHOLD = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(the longest rule that covers host and path, its verdict); nulls where none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, outcome in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, outcome).otherwise(verdict)
    return rule, verdict


def judged_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    rows = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.withColumn("rule", rule).withColumn("by_rule", verdict)


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts."""
    links = pages.select(
        host_of(F.col("url")).alias("src"),
        F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""), 1)).alias("to"),
    )
    # ``//host/`` has the scheme of its page.
    whole = F.when(F.startswith("to", F.lit("//")), F.concat(F.lit("page:"), "to")).otherwise(F.col("to"))
    return (
        links.select("src", host_of(whole).alias("dst"))
        .where("src <> '' and dst <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def personalised(
    edges: DataFrame, seeds: DataFrame, label: str, damping: float = DAMPING, most: int = MOST_ITERATIONS
) -> DataFrame:
    """(host, score) of the PageRank along ``edges`` (src, dst, n) from ``seeds`` (host, weight, summing to 1)."""
    total = edges.groupBy("src").agg(F.sum("n").alias("out"))
    steps = stored(edges.join(total, "src").select("src", "dst", (F.col("n") / F.col("out")).alias("w")), label + "-edges")
    base = stored(seeds.select("host", (F.col("weight") * (1 - damping)).alias("score")), label + "-seeds")
    if not steps.limit(1).count():
        return base
    now = base
    for k in range(1, most + 1):
        moved = now.join(steps, F.col("host") == F.col("src")).select(
            F.col("dst").alias("host"), (F.col("score") * F.col("w") * damping).alias("score")
        )
        new = base.unionAll(moved).groupBy("host").agg(F.sum("score").alias("score"))
        if k % WRITE_EVERY == 0:
            new = stored(new, label)
            if _change(now, new) < SETTLED:
                return new
        now = new
    raise RuntimeError(f"scores still change after {most} iterations")


def _change(old: DataFrame, new: DataFrame) -> float:
    both = new.join(old.withColumnRenamed("score", "old"), "host", "left")
    return both.agg(F.sum(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0))))).first()[0] or 0.0


def host_scores(pages: DataFrame, rules=RULES) -> DataFrame:
    """(host, trust, distrust) of the hosts that a score reaches; trust and distrust are of all seeds' mass."""
    judged = judged_by_rules(pages, rules)
    edges = stored(host_links(pages), "links")
    counts = stored(
        judged.where("host <> '' and by_rule is not null").groupBy("host", "by_rule").agg(F.count(F.lit(1)).alias("n")), "seeds"
    )
    scores = []
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    for verdict, graph, name in (("allow", edges, "trust"), ("block", back, "distrust")):
        own = counts.where(F.col("by_rule") == verdict)
        mass = own.agg(F.sum("n")).first()[0] or 1
        seeds = own.select("host", (F.col("n") / F.lit(mass)).alias("weight"))
        scores.append(personalised(graph, seeds, name).withColumnRenamed("score", name))
    joined = reduce(lambda x, y: x.join(y, "host", "full"), scores)
    return joined.select("host", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("trust", "distrust")))


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    blocked = host_scores(pages, rules).where(F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))).select(
        "host", F.lit(True).alias("distrusted")
    )
    rows = judged_by_rules(pages.select("page_id", "url"), rules).join(blocked, "host", "left")
    return rows.select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("distrusted"), "block").otherwise("allow")).alias("verdict"),
    )
