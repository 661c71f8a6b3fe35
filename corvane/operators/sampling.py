"""Reproducible sampling without replacement, and how a sample lies over the positions.

Randomness is a hash of the id, so a sample doesn't depend on partitions. A weighted sample takes the
n largest of ``u ** (1 / w)`` (as the n least of ``-ln(u) / w``), so each is one bounded top-n and
nothing is sorted whole. ``position`` runs from 0 to ``total - 1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD, LEAST_WEIGHT = 5.0, 0.01  # fixed values of the decay laws


def uniform(id_column: str, seed: str = "") -> Column:
    """In (0, 1), from the id's MD5; the same in any engine."""
    head = F.conv(F.left(F.md5(F.concat(F.lit(seed), F.col(id_column).cast("string")).cast("binary")), F.lit(8)), 16, 10).cast("double")
    return (head + 1) / F.lit(4294967297.0)


def weight(strategy: str, position: str, total: int, strength: float) -> Column:
    from_end = (F.lit(total - 1) - F.col(position)).cast("double")
    if strategy == "random":
        return F.lit(1.0)
    if strategy == "exponential_decay":
        return F.exp(-SPREAD * strength * from_end / total)
    if strategy == "linear_decay":
        return F.greatest(F.lit(LEAST_WEIGHT), 1.0 - strength * from_end / total)
    raise ValueError(f"unknown strategy {strategy}")


def tail_heavy_counts(total: int, n: int, ratio: float) -> tuple[int, int]:
    """How many of the lower and the upper half: int(n * ratio) above, each capped, the rest refilled."""
    middle = total // 2
    tail = int(n * ratio)
    head, tail = min(n - tail, middle), min(tail, total - middle)
    short = n - head - tail
    if short > 0 and middle > head:
        head = min(head + short, middle)
    elif short > 0:
        tail = min(tail + short, total - middle)
    return head, tail


def sample(rows: DataFrame, n: int, strategy: str = "random", position: str = "row_index", strength: float = 0.8, id_column: str | None = None, total: int | None = None, seed: str = "") -> DataFrame:
    """``rows`` of the sample; all rows if there are no more than ``n``.

    Positions must be those of a store of ``total`` rows, from 0 on. Without ``total`` a first pass counts the rows and looks at
    their positions: ValueError if one lies outside. With it there is one scan, and a row outside ends the job.
    """
    at = F.col(position)
    if total is None:
        met = rows.agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("low"), F.max(position).alias("high")).first()
        total = met["n"]
        if total and not 0 <= met["low"] <= met["high"] < total:
            raise ValueError(f"positions from {met['low']} to {met['high']} are none of a store of {total} rows")
    else:
        outside = F.raise_error(F.format_string(f"position %s is none of a store of {total} rows", at.cast("string"))).cast("boolean")
        rows = rows.where(F.when((at >= 0) & (at < total), True).otherwise(outside))
    name = id_column or position
    if strategy == "tail_heavy":
        head, tail = tail_heavy_counts(total, min(n, total), strength)
        low, high = rows.where(at < total // 2), rows.where(at >= total // 2)
        return low.orderBy(uniform(name, seed), position).limit(head).unionAll(high.orderBy(uniform(name, seed), position).limit(tail))
    return rows.orderBy(-F.log(uniform(name, seed)) / weight(strategy, position, total, strength), position).limit(n)


def first_rows(rows: DataFrame, n: int, position: str = "row_index") -> DataFrame:
    """The first ``n`` in stored order."""
    return rows.orderBy(position).limit(n)


def quartiles(sampled: DataFrame, total: int, position: str = "row_index") -> DataFrame:
    """quartile (1 to 4), low, high (inclusive), n, percent; empty quartiles stay."""
    edges = [0, total // 4, total // 2, 3 * total // 4, total]
    one = sampled.agg(F.count(F.lit(1)).alias("all"), *[F.count_if((F.col(position) >= a) & (F.col(position) < b)).alias(f"n{i}") for i, (a, b) in enumerate(zip(edges, edges[1:]))])
    entries = [F.struct(F.lit(i + 1).alias("quartile"), F.lit(a).cast("long").alias("low"), F.lit(b - 1).cast("long").alias("high"), F.col(f"n{i}").alias("n"), F.round(F.coalesce(F.try_divide(F.col(f"n{i}") * 100.0, F.col("all")), F.lit(0.0)), 6).alias("percent")) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def mean_position(sampled: DataFrame, total: int, position: str = "row_index") -> DataFrame:
    """n, mean_position, share (of the last position) of a sample."""
    one = sampled.agg(F.count(F.lit(1)).alias("n"), F.avg(position).alias("mean_position"))
    return one.withColumn("share", F.try_divide(F.col("mean_position"), F.lit(float(max(1, total - 1)))))


def density(sampled: DataFrame, total: int, bins: int = 20, position: str = "row_index") -> DataFrame:
    """bin, n for the bins that have rows; the last bin takes what the division leaves."""
    width = max(1, total // bins)
    return sampled.groupBy(F.least(F.floor(F.col(position) / width), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
