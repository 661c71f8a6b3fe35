"""Connected components of links in Spark, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Every node hands its larger neighbours the least node it knows.

    The least nodes are written before the join, so that a hub's edges can be split over tasks.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = scratch.keep(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")))
    return both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, the least of them; edges have a > b."""
    least = scratch.keep(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m"))
    moved = edges.join(least, F.col("a") == F.col("n")).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b): component is the least node reachable.

    Components that consist of their least node alone, and the least nodes themselves, have no row.
    The number of rounds grows with the logarithm of the longest path; each round is written to the
    shared folder, so a lost executor costs at most one round.
    """
    now = scratch.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        new = scratch.keep(_small_star(scratch.keep(_large_star(now, scratch)), scratch))
        told = tuple(new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        scratch.drop(now)
        now = new
        if told == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = told
