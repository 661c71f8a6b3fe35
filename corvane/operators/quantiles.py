"""Exact quantiles in rounds: cut points around each rank, counts over them, and on in what lies between, until that is small.

A sketch of bounded size gives cut points a little below, at and above each wanted rank. One pass counts exactly how many
values are equal to each cut point and how many lie between two. A rank that falls on a cut point is
done, however many equal values there are; any other lies between two of them, where a few thousandths of the
values are left. What is left goes into the next round, and once it fits ``BOUND`` it is fetched and
sorted. So no state grows with the number of distinct values.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import delete, shared_folder

BOUND = 100_000  # values that the driver sorts
ACCURACY = 10_000  # of the sketch: its rank error is a share of 1 / ACCURACY


def _counts(values: DataFrame, cuts: np.ndarray) -> np.ndarray:
    """How many values lie below the first cut point, are equal to it, lie between it and the next, and so on; no number counts as the largest."""

    def work(frames):
        found = np.zeros(2 * len(cuts) + 1, np.int64)
        for frame in frames:
            x = frame.column(0).to_numpy(zero_copy_only=False)
            slots = np.searchsorted(cuts, x, "left") + np.searchsorted(cuts, x, "right")
            found += np.bincount(slots, minlength=len(found))
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found[at], pa.int64())], names=["slot", "n"])

    out = np.zeros(2 * len(cuts) + 1, np.int64)
    for row in values.mapInArrow(work, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # a row a slot
        out[row["slot"]] = row["n"]
    return out


def _at_ranks(values: DataFrame, n: int, ranks: list[int], bound: int, accuracy: int) -> dict[int, float]:
    """The values of some ranks (from 0) among ``n`` values of a written one-column frame ``x``."""
    if not ranks:
        return {}
    if n <= bound:
        held = np.sort(np.array([r["x"] for r in values.collect()], np.float64))
        return {r: float(held[r]) for r in ranks}
    shares = sorted({min(1.0, max(0.0, r / (n - 1) + d / accuracy)) for r in ranks for d in (-2, 0, 2)})
    cuts = np.unique(np.array(values.agg(F.percentile_approx("x", [float(s) for s in shares], accuracy).alias("c")).first()["c"], np.float64))
    counts = _counts(values, cuts)
    ends, out, further = np.cumsum(counts), {}, {}
    for rank in ranks:
        slot = int(np.searchsorted(ends, rank, "right"))
        if slot % 2:
            out[rank] = float(cuts[slot // 2])
        else:
            further.setdefault(slot, []).append(rank)
    for slot, some in further.items():
        inside: Column = F.lit(True)
        if slot:
            inside = inside & (F.col("x") > float(cuts[slot // 2 - 1]))
        if slot // 2 < len(cuts):
            inside = inside & (F.col("x") < float(cuts[slot // 2]))
        before = int(ends[slot - 1]) if slot else 0
        out |= {r + before: v for r, v in _at_ranks(values.where(inside), int(counts[slot]), [r - before for r in some], bound, accuracy).items()}
    return out


def exact_quantiles(frame: DataFrame, column: str, shares: Sequence[float], bound: int = BOUND, accuracy: int = ACCURACY) -> list[float | None]:
    """The quantiles of a column at ``shares`` (0 to 1), by linear interpolation between neighbours; nulls don't count, and of nothing they are null.

    The values are written once, as one column, and read by each round.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/corvane-values-{uuid.uuid4().hex}"
    try:
        frame.select(F.col(column).cast("double").alias("x")).where("x is not null").write.parquet(path)
        values = spark.read.schema("x double").parquet(path)
        n = values.count()
        if not n:
            return [None] * len(shares)
        places = [s * (n - 1) for s in shares]
        found = _at_ranks(values, n, sorted({r for p in places for r in (math.floor(p), math.ceil(p))}), bound, accuracy)
    finally:
        delete(spark, path)
    out = []
    for p in places:
        low, high = found[math.floor(p)], found[math.ceil(p)]
        out.append(low if low == high else low + (high - low) * (p - math.floor(p)))
    return out
