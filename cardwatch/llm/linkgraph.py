"""URL filter by rules and by trust that spreads along links between hosts.

Rules of host and path allow or block some urls; the longest fitting rule wins. Hosts with
allowed pages are trusted seeds and hosts with blocked pages distrusted ones, each with a mass
of 1 in all, shared out by its own pages, so that no verdict depends on how many other seeds
there are. Personalised PageRank carries trust from the trusted seeds along links, and
distrust from the blocked seeds against them (who links to a blocked host is suspect). A url
without a rule is blocked where distrust is more than ``max_share`` of its host's trust and
distrust together.

Edges are the distinct pairs of different hosts with the number of links between them, in
``href`` and ``src`` of any case, with a scheme or protocol-relative (``//host``), so the
iteration moves hosts, not pages. Every few rounds the ranks are written to the shared folder
and compared with those before: it ends when each graph's have changed by less than ``TOLERANCE``
of their sum and no host's by more than ``HOST_TOLERANCE`` of itself, since verdicts compare the small
ranks of far hosts. So every host that links reach has a rank, however far.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule,
and is allowed; null html has no links. Hosts that no seed reaches have no rank and are
allowed. Repeated rows count as often as they stand. Empty tables give empty results. Other
columns are not read.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: (verdict, rule); what stands before the first slash is the host.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
DAMPING, MAX_SHARE = 0.85, 0.9
#: The ranks have settled below these: total change of a graph's ranks as a share of their sum,
#: and change of a host's rank as a share of it.
TOLERANCE, HOST_TOLERANCE = 1e-12, 1e-6
#: After so many rounds the total change is below TOLERANCE in any graph.
ROUNDS = math.ceil(math.log(TOLERANCE / 2) / math.log(DAMPING))
ROUNDS_AT_ONCE = 5
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?is)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def lowered(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: str = "url") -> Column:
    return lowered(F.coalesce(F.regexp_extract(F.col(url), URL, 1), F.lit("")))


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), URL, 2), F.lit(""))


def fits(rule: str, host: str = "host", path: str = "path") -> Column:
    name, slash, rest = rule.partition("/")
    return ((F.col(host) == name) | F.endswith(F.col(host), F.lit("." + name))) \
        & F.startswith(F.col(path), F.lit(slash + rest))


def with_rules(df: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` and ``ruled`` (its verdict) to columns ``host`` and ``path``."""
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):  # the longest comes last
        rule = F.when(fits(r), F.lit(r)).otherwise(rule)
        ruled = F.when(fits(r), F.lit(verdict)).otherwise(ruled)
    return df.withColumn("rule", rule).withColumn("ruled", ruled)


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts."""
    return (pages.filter(F.contains(F.col(html), F.lit("//")))
            .select(F.col(host).alias("src"),
                    F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)))
                    .alias("dst"))
            .withColumn("dst", lowered(F.col("dst")))
            .filter("src != dst AND src != ''").groupBy("src", "dst")
            .agg(F.count("*").alias("n")))


def settled(last: DataFrame, rank: DataFrame) -> bool:
    """Whether ``rank`` has hardly changed against ``last``; a host new in it has."""
    both = rank.join(last.withColumnRenamed("rank", "last"), ["graph", "host"], "left")
    change = F.abs(F.col("rank") - F.coalesce("last", F.lit(0.0)))
    rows = both.groupBy("graph").agg(
        F.sum(change).alias("total"), F.sum("rank").alias("mass"),
        F.max(F.when(F.col("rank") > 0, change / F.col("rank"))).alias("host")).collect()
    return all(r["total"] <= TOLERANCE * r["mass"] and (r["host"] or 0.0) <= HOST_TOLERANCE for r in rows)


def page_rank(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank of several graphs at once.

    ``edges``: (graph, src, dst, n); ``seeds``: (graph, host, mass). Returns (graph, host,
    rank). The rank of a host without links ends there.
    """
    out = edges.groupBy("graph", "src").agg(F.sum("n").alias("total"))
    e = materialize(edges.join(out, ["graph", "src"]).select(
        "graph", F.col("src").alias("host"), "dst", (F.col("n") / F.col("total")).alias("w")),
        "link_edges")
    start = seeds.select("graph", "host", (F.col("mass") * (1 - damping)).alias("rank"))
    rank = seeds.select("graph", "host", F.col("mass").alias("rank"))
    while True:
        last = rank
        for _ in range(ROUNDS_AT_ONCE):
            moved = rank.join(e, ["graph", "host"]).select(
                "graph", F.col("dst").alias("host"), (F.col("rank") * F.col("w") * damping)
                .alias("rank"))
            rank = moved.unionByName(start).groupBy("graph", "host").agg(
                F.sum("rank").alias("rank"))
        rank = materialize(rank, "link_ranks")
        if settled(last, rank):
            return rank


def host_verdicts(ruled: DataFrame, edges: DataFrame, max_share: float = MAX_SHARE,
                  **kw) -> DataFrame:
    """(host, trust, distrust, blocked) of every host that a seed reaches."""
    own = ruled.filter("ruled IS NOT NULL").groupBy("host").agg(
        *[F.avg((F.col("ruled") == g).cast("double")).alias(g) for g in ("allow", "block")])
    masses = F.explode(F.array(*[F.struct(F.lit(g).alias("graph"), F.col(g).alias("mass"))
                                 for g in ("allow", "block")])).alias("s")
    seeds = materialize(own.select("host", masses).select("s.graph", "host", "s.mass")
                        .filter("mass > 0"), "link_seeds")
    both = edges.select(F.lit("allow").alias("graph"), "src", "dst", "n").unionByName(
        edges.select(F.lit("block").alias("graph"), F.col("dst").alias("src"),
                     F.col("src").alias("dst"), "n"))
    rank = page_rank(both, seeds, **kw)
    side = {g: F.coalesce(F.sum(F.when(F.col("graph") == g, F.col("rank"))), F.lit(0.0))
            for g in ("allow", "block")}
    return (rank.groupBy("host").agg(side["allow"].alias("trust"), side["block"].alias("distrust"))
            .withColumn("blocked", F.col("distrust")
                        > max_share * (F.col("trust") + F.col("distrust"))))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", rules=RULES, **kw) -> DataFrame:
    """(id, host, path, rule, verdict) of every page."""
    placed = with_rules(pages.select(F.col(id_col).alias(id_col), host_of(url_col).alias("host"),
                                     path_of(url_col).alias("path"),
                                     F.col(html_col).alias("html")), rules)
    edges = materialize(host_edges(placed), "link_counts")
    verdicts = materialize(host_verdicts(placed.drop("html"), edges, **kw), "link_verdicts")
    return (placed.drop("html").join(verdicts.filter("blocked").select("host", "blocked"),
                                     "host", "left")
            .select(id_col, "host", "path", "rule", F.coalesce(
                "ruled", F.when(F.col("blocked"), "block"), F.lit("allow")).alias("verdict")))
