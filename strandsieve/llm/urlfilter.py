"""URL verdicts from rules, and from trust and distrust carried over the host graph.

Rules come first: a rule (host, path) fits its host and all subdomains where the url's path starts with the rule's; the
longest fitting rule decides. For the rest, hosts are judged: links in the pages give weighted edges between hosts;
trust is a personalised PageRank from hosts whose pages rules allow, distrust one over reversed edges from hosts whose
pages rules block (who links to blocked hosts is suspect). A host is blocked if its distrust is at least `threshold` and
over its trust. All of it is DataFrame operations; an iteration is one join and one sum over the edges.

Scores are not normalised over the graph: rank = (1 - d) * seed + d * sum of the shares that flow in, a seed being the
share of a host's pages that rules allow (block). Trust is divided among the links of the host that gives it. Distrust is
weighed by the links of the host that takes it: a link counts as its share of the linking host's links, however many others
link to the same place. So the threshold means the same at every size of the graph and for every number of linkers: a host
all of whose links go to a wholly blocked one has d * (1 - d) = 0.1275, and 0.05 is about two links in five.

Edge cases: null urls and urls without `://` have empty host and path and are judged by the empty host's score (no seeds,
so they are allowed); null html has no links; relative and same-host links are no edges; repeated pages count as often;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandsieve.llm.common import bounded, discard, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
THRESHOLD = 0.05
#: Ranks stand still once none moves by more than this share of itself (of the threshold, if smaller); steps until an error.
TOLERANCE, MOST_STEPS = 1e-6, 500


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r)):  # later ones stand outside and win
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.host + r.path)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst and number of links between different hosts, from the href attributes of absolute links."""
    links = F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""), 1)
    pairs = pages.select(host_of(F.col("url")).alias("src"), F.explode(links).alias("_to"))
    to = F.when(F.col("_to").startswith("//"), F.concat(F.lit("x:"), F.col("_to"))).otherwise(F.col("_to"))
    pairs = pairs.select("src", host_of(to).alias("dst")).where((F.col("src") != F.col("dst")) & (F.col("dst") != ""))
    return pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, among: str = "src") -> DataFrame:
    """host, rank: personalised PageRank of `seeds` (host, seed) over `edges` (src, dst, weight), until it stands still.

    An edge's share is its weight over that of all edges of its `src`, or of its `dst` if `among` says so.
    Both are written tables. Each step's ranks are written to the shared folder, so lineage stays one step long. What a step
    changes shrinks by the damping factor, so about 85 steps suffice where links go in circles, and a few where not.
    """
    out = edges.groupBy(among).agg(F.sum("weight").alias("_all"))
    flows, flow_path = written(edges.join(out, among).select("src", "dst", (F.col("weight") / F.col("_all")).alias("share")), "flows")
    start = seeds.select("host", ((1 - damping) * F.col("seed")).alias("rank"))
    rank, path = written(start, "rank")
    if flows.isEmpty():
        return rank
    for _ in range(MOST_STEPS):
        came = flows.join(bounded(rank), flows.src == rank.host).groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("_in"))
        moved = (
            came.select("host", (damping * F.col("_in")).alias("rank"))
            .unionByName(start)
            .groupBy("host")
            .agg(F.sum("rank").alias("rank"))
        )
        new, new_path = written(moved, "rank")
        moved_by = F.abs(F.col("_new") - F.coalesce(F.col("rank"), F.lit(0.0))) / F.greatest(F.col("_new"), F.lit(THRESHOLD))
        delta = new.withColumnRenamed("rank", "_new").join(bounded(rank), "host", "left").agg(F.max(moved_by)).first()[0]
        discard(rank.sparkSession, path)
        rank, path = new, new_path
        if (delta or 0.0) < TOLERANCE:
            break
    else:
        raise RuntimeError("ranks did not settle")
    discard(rank.sparkSession, flow_path)
    return rank


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of each page."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).withColumns({"rule": text, "_verdict": verdict})
    seeds = judged.groupBy("host").agg(
        F.avg(F.when(F.col("_verdict") == "allow", 1.0).otherwise(0.0)).alias("allowed"),
        F.avg(F.when(F.col("_verdict") == "block", 1.0).otherwise(0.0)).alias("blocked"),
    )
    seeds, seed_path = written(seeds, "seeds")
    edges, edge_path = written(host_edges(pages), "edges")
    trust = propagate(edges, seeds.where("allowed > 0").select("host", F.col("allowed").alias("seed")))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = propagate(back, seeds.where("blocked > 0").select("host", F.col("blocked").alias("seed")), among="dst")
    hosts, _ = written(
        trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host", "full").select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")),
        "hosts",
    )
    discard(hosts.sparkSession, seed_path)
    discard(hosts.sparkSession, edge_path)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    bad = (zero("distrust") >= threshold) & (zero("distrust") > zero("trust"))
    return judged.join(bounded(hosts), "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("_verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"), zero("trust"), zero("distrust")
    )
