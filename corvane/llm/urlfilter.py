"""URL filter: rules by host and path, and link-graph propagation for what no rule covers.

Trust flows from the hosts that rules allow along host links (personalised PageRank); distrust flows
from the hosts that rules block against the links, since who links to a blocked host is suspect. Both
run in one loop over one edge table. Hosts are linked by the absolute links of their pages, and
subdomains both ways with their parent domain. A page without a rule is blocked where its host's
distrust exceeds its trust ``ratio`` times.

All of it is DataFrame operations, but for that walk over distinct hosts. Links are counted per pair of hosts before the loop, so the loop
sees host pairs and not pages; sums are combined before they are shuffled. Rules are joined to
distinct hosts over the hosts' suffixes, so a long list of rules costs a join and no scan per rule. In
the graph a host is 16 bytes; those of its parent domains come from one walk over its labels, so a host
with thousands of labels costs time and space linear in its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mapped

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
DAMPING, ROUNDS, RATIO = 0.85, 20, 1.0
KEEP_EVERY = 5  # rounds between written states
HUB_EDGES = 100_000  # edges of one node that one task may meet
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)href\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s\"'<>]+)"  # with a scheme, or with the page's own


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def node_of(host: Column) -> Column:
    """A host as 16 bytes: the MD5 of its reverse, so that those of all parent domains come from one walk (``_domain_pairs``)."""
    return F.unhex(F.md5(F.reverse(host).cast("binary")))


def _domain_pairs(frames):
    """domain, parent (nodes) of each host and its parent domains, in time linear in the host's length; the last label has no node."""
    for frame in frames:
        found = []
        for host in frame.column(0).to_pylist():
            labels = host[::-1].split(".")
            walk, before = hashlib.md5(labels[0].encode("utf-8", "surrogatepass")), None
            for label in labels[1:]:
                walk.update(b"." + label.encode("utf-8", "surrogatepass"))
                node = walk.digest()
                if before:
                    found.append((node, before))
                before = node
                if len(found) >= 10_000:
                    yield _pairs_batch(found)
                    found = []
        yield _pairs_batch(found)


def _pairs_batch(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)], names=["domain", "parent"])


def rule_hosts(host: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The host's suffixes that have as many labels as the host of some rule."""
    labels = sorted({h.count(".") + 1 for _, h, _ in rules})
    return F.array_distinct(F.array(*[F.substring_index(host, ".", -n) for n in labels]))  # with fewer labels the host itself


def read_pages(pages: DataFrame) -> DataFrame:
    """page_id, host, path, targets: the distinct other hosts that the page links to."""
    links = F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1)), lambda u: host_of(F.when(u.startswith("//"), F.concat(F.lit(":"), u)).otherwise(u)))
    return pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.array_distinct(links).alias("targets")).withColumn("targets", F.expr("filter(targets, t -> t <> '' and t <> host)"))


def host_edges(read: DataFrame, domain_links: bool = True) -> DataFrame:
    """source, target, weight of host pairs (nodes): pages that link, and 1 between subdomain and domain."""
    pairs = read.where("host <> ''").select("host", F.explode("targets").alias("to"))
    linked = pairs.select(node_of(F.col("host")).alias("source"), node_of(F.col("to")).alias("target")).groupBy("source", "target").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    if not domain_links:
        return linked
    hosts = read.where("host <> ''").select("host").distinct().unionByName(pairs.select(F.col("to").alias("host"))).distinct()
    parent = mapped(hosts, _domain_pairs, "domain binary, parent binary").distinct()
    up = parent.select(F.col("domain").alias("source"), F.col("parent").alias("target"), F.lit(1.0).alias("weight"))
    down = parent.select(F.col("parent").alias("source"), F.col("domain").alias("target"), F.lit(1.0).alias("weight"))
    return linked.unionByName(up).unionByName(down).groupBy("source", "target").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, scratch: Scratch, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """graph, node, rank after ``rounds`` rounds; edges: graph, source, target, weight; seeds: graph, node, weight.

    Seeds of a graph are scaled to sum 1. Rank that reaches a node without edges stays out of the
    next round, so ranks of a graph sum to at most 1. The edges of a hub are dealt over parts of about
    HUB_EDGES, and its rank is sent to each of them.
    """
    out = scratch.keep(edges.groupBy("graph", "source").agg(F.sum("weight").alias("total"), F.ceil(F.count(F.lit(1)) / HUB_EDGES).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("target"), F.col("parts")).cast("int").alias("salt")
    shares = scratch.keep(edges.join(out, ["graph", "source"]).select("graph", "source", part, "target", (F.col("weight") / F.col("total")).alias("share")))
    hubs = scratch.keep(out.where("parts > 1").select("graph", F.col("source").alias("node"), "parts"))
    sums = seeds.groupBy("graph").agg(F.sum("weight").alias("total"))
    start = scratch.keep(seeds.join(F.broadcast(sums), "graph").select("graph", "node", (F.col("weight") / F.col("total")).alias("rank")))  # one row a graph
    rank = start
    base = start.select("graph", "node", (F.col("rank") * (1 - damping)).alias("part"))
    for number in range(1, rounds + 1):
        salted = rank.join(hubs, ["graph", "node"], "left").select("graph", F.col("node").alias("source"), "rank", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("salt"))
        sent = shares.join(salted, ["graph", "source", "salt"]).select("graph", F.col("target").alias("node"), (F.col("rank") * F.col("share") * damping).alias("part"))
        rank = sent.unionByName(base).groupBy("graph", "node").agg(F.sum("part").alias("rank"))
        if number % KEEP_EVERY == 0:
            rank = scratch.keep(rank)
    return rank


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, damping: float = DAMPING, rounds: int = ROUNDS, ratio: float = RATIO) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row of ``pages`` (page_id, url, html).

    A rule (verdict, host, path) fits its host and all subdomains where the path starts with its own;
    the longest wins, of equally long ones the first in order of text. A null url, or one without ``://``,
    has an empty host and path, no rule, and is allowed; a null html has no links; repeated rows are
    judged alike; an empty table gives an empty result; further columns are ignored. Urls and hosts may be
    of any length and number of labels: the work on one is linear in its length.
    """
    spark, scratch = pages.sparkSession, Scratch(pages.sparkSession)
    read = scratch.keep(read_pages(pages))
    table = spark.createDataFrame([(h, p, h + p, v) for v, h, p in rules], "rule_host string, rule_path string, rule string, says string")
    hosts = read.where("host <> ''").select("host").distinct()
    fitting = hosts.withColumn("rule_host", F.explode(rule_hosts(F.col("host"), rules))).join(table, "rule_host")
    of_host = scratch.keep(fitting.groupBy("host").agg(F.array_sort(F.collect_set(F.struct((-F.length("rule")).alias("order"), "rule", "rule_path", "says"))).alias("rules")))  # at most the rules
    ruled = read.select("page_id", "host", "path").join(of_host, "host", "left").withColumn("hit", F.expr("try_element_at(filter(rules, r -> startswith(path, r.rule_path)), 1)")).select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.says").alias("says"))
    ruled = scratch.keep(ruled)
    edges = host_edges(read)
    both = scratch.keep(edges.select(F.lit("trust").alias("graph"), "source", "target", "weight").unionByName(edges.select(F.lit("distrust").alias("graph"), F.col("target").alias("source"), F.col("source").alias("target"), "weight")))
    seeds = ruled.where("rule is not null").groupBy(F.when(F.col("says") == "allow", "trust").otherwise("distrust").alias("graph"), node_of(F.col("host")).alias("node")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    rank = propagate(both, seeds, scratch, damping, rounds)
    score = scratch.keep(rank.groupBy("node").agg(F.sum(F.when(F.col("graph") == "trust", F.col("rank")).otherwise(0.0)).alias("trust"), F.sum(F.when(F.col("graph") == "distrust", F.col("rank")).otherwise(0.0)).alias("distrust")))
    scratch.drop_others(ruled, score)
    judged = ruled.withColumn("node", node_of(F.col("host"))).join(score, "node", "left").na.fill(0.0, ["trust", "distrust"])
    method = F.when(F.col("distrust") > F.col("trust") * ratio + 1e-12, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("says", method).alias("verdict"), F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust"))
