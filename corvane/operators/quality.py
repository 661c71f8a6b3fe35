"""Statistics and integrity of vector tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vector as V
from .quantiles import exact_quantiles

CONSISTENT = 0.98
SIDES = ("title_embedding", "abstract_embedding")


def matrix_stats(vectors: DataFrame, column: str) -> DataFrame:
    """Over all values of a vector column: mean, std, least, largest, zero_share, mean_norm, nan_count.

    Each row is reduced to partial sums first, so no row is exploded.
    """
    v = F.col(column)
    row = vectors.select(
        F.size(v).alias("n"),
        F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double")).alias("s"),
        F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")).alias("q"),
        F.array_min(v).alias("low"),
        F.array_max(v).alias("high"),
        V.zero_count(v).alias("zeros"),
        V.nan_count(v).alias("nans"),
    )
    n = F.sum("n")
    mean = F.try_divide(F.sum("s"), n)
    return row.agg(
        n.alias("n_values"), mean.alias("mean"), F.sqrt(F.greatest(F.try_divide(F.sum("q"), n) - mean * mean, F.lit(0.0))).alias("std"), F.min("low").cast("double").alias("least"), F.max("high").cast("double").alias("largest"),
        F.try_divide(F.sum("zeros"), n).alias("zero_share"), F.avg(F.sqrt("q")).alias("mean_norm"), F.sum("nans").alias("nan_count"),
    )


def pair_stats(vectors: DataFrame, a: str = SIDES[0], b: str = SIDES[1]) -> DataFrame:
    """mean, std, least, largest of the row-wise cosine."""
    c = vectors.select(V.cosine(a, b).alias("c"))
    return c.agg(F.avg("c").alias("mean"), F.stddev_pop("c").alias("std"), F.min("c").alias("least"), F.max("c").alias("largest"))


def dimension_stats(vectors: DataFrame, column: str) -> DataFrame:
    """dim (from 1), mean, std (population), least, largest of each dimension, of vectors of any lengths; nulls don't count.

    Each task reduces its vectors to one row a dimension; those meet, not the values.
    """
    out = "dim bigint, n bigint, mean double, spread double, least double, largest double"

    def work(frames):
        held = np.zeros((5, 0))  # n, mean, squared deviations, least, largest
        for frame in frames:
            lists = frame.column(0)
            flat, lengths = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(lists.offsets.to_numpy())
            place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            size = max(held.shape[1], int(lengths.max(initial=0)))
            n = np.bincount(place, minlength=size).astype(float)
            mean = np.divide(np.bincount(place, flat, size), n, out=np.zeros(size), where=n > 0)
            spread = np.bincount(place, (flat - mean[place]) ** 2, size)
            least, largest = np.full(size, np.inf), np.full(size, -np.inf)
            np.minimum.at(least, place, flat)
            np.maximum.at(largest, place, flat)
            old = np.zeros((5, size))
            old[3], old[4] = np.inf, -np.inf
            old[:, : held.shape[1]] = held
            total = old[0] + n
            shift = np.divide(n, total, out=np.zeros(size), where=total > 0) * (mean - old[1])
            held = np.stack([total, old[1] + shift, old[2] + spread + old[0] * shift * (mean - old[1]), np.minimum(old[3], least), np.maximum(old[4], largest)])
        if held.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, held.shape[1] + 1)), pa.array(held[0].astype(np.int64)), *map(pa.array, held[1:])], names=["dim", "n", "mean", "spread", "least", "largest"])

    sums = vectors.where(F.col(column).isNotNull()).select(F.filter(column, lambda x: x.isNotNull()).alias("v")).mapInArrow(work, out)
    centre = sums.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("mean")).alias("sum"), F.sum(F.col("spread") + F.col("n") * F.col("mean") * F.col("mean")).alias("squares"), F.min("least").alias("least"), F.max("largest").alias("largest"))
    mean = F.col("sum") / F.col("n")
    return centre.where("n > 0").select("dim", mean.alias("mean"), F.sqrt(F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0))).alias("std"), "least", "largest")


def dimension_ranges(per_dimension: DataFrame) -> DataFrame:
    """statistic, low, high: the range over the dimensions of each statistic."""
    names = ("mean", "std", "least", "largest")
    one = per_dimension.agg(*[f(n).alias(f"{n}_{k}") for n in names for k, f in (("low", F.min), ("high", F.max))])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("statistic"), F.col(f"{n}_low").alias("low"), F.col(f"{n}_high").alias("high")) for n in names])).alias("e")).select("e.*")


def norm_stats(vectors: DataFrame, column: str) -> DataFrame:
    n = vectors.select(V.norm(column).alias("n"))
    return n.agg(F.avg("n").alias("mean"), F.stddev_pop("n").alias("std"), F.min("n").alias("least"), F.max("n").alias("largest"))


def row_stats(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """id, norm, mean, std, least, largest of each vector."""
    return vectors.select(id_column, V.norm(column).alias("norm"), V.element_mean(column).alias("mean"), V.element_std(column).alias("std"), F.array_min(column).cast("double").alias("least"), F.array_max(column).cast("double").alias("largest"))


def equal_width_histogram(values: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """bin (1 to ``bins``), n of the bins that have rows, between the least and the largest value (which the last bin takes)."""
    ends = values.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    at = F.when(F.col("high") > F.col("low"), F.least(F.floor((F.col(column) - F.col("low")) / ((F.col("high") - F.col("low")) / bins)) + 1, F.lit(bins))).otherwise(F.lit(1))
    return values.where(F.col(column).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def integrity(vectors: DataFrame, id_column: str = "paper_id", sides: tuple[str, ...] = SIDES, nan_rows: int | None = None, position: str = "row_index") -> DataFrame:
    """check, value, ok: rows without vectors, differing dimensions, duplicate ids, rows with NaN.

    ``nan_rows`` looks for NaN in the first so many rows only.
    """
    looked = F.lit(True) if nan_rows is None else F.col(position) < nan_rows
    checks: list[tuple[str, Column]] = [("duplicate_ids", F.count(F.lit(1)) - F.count_distinct(id_column) - F.count_if(F.col(id_column).isNull()))]
    for s in sides:
        checks += [
            (f"{s}_missing", F.count_if(F.col(s).isNull())),
            (f"{s}_dims", F.greatest(F.max(F.size(s)) - F.min(F.size(s)), F.lit(0)).cast("long")),
            (f"{s}_nan_rows", F.count_if(looked & (V.nan_count(s) > 0))),
        ]
    if len(sides) == 2:
        checks.append(("dims_between_sides", F.count_if(F.size(sides[0]) != F.size(sides[1]))))
    one = vectors.agg(*[c.alias(n) for n, c in checks])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.coalesce(F.col(n), F.lit(0)).cast("long").alias("value")) for n, _ in checks])).alias("e")).select("e.check", "e.value", (F.col("e.value") == 0).alias("ok"))


def audit(pairs: DataFrame, similarity: str = "similarity", least: float = CONSISTENT) -> DataFrame:
    """consistent, inconsistent, failed (null) and the spread of re-embedding similarities; the quartiles are exact (``quantiles``)."""
    s = F.col(similarity)
    p25, median, p75 = (F.lit(q).cast("double") for q in exact_quantiles(pairs, similarity, [0.25, 0.5, 0.75]))
    return pairs.agg(
        F.count_if(s >= least).alias("consistent"), F.count_if(s < least).alias("inconsistent"), F.count_if(s.isNull()).alias("failed"), F.min(s).alias("least"), F.max(s).alias("largest"), F.avg(s).alias("mean"),
        median.alias("median"), F.stddev_pop(s).alias("std"), p25.alias("p25"), p75.alias("p75"),
    )


def passes(pairs: DataFrame, similarity: str = "similarity", above: float = 0.95) -> DataFrame:
    """mean, passed: whether the mean similarity is strictly above the limit."""
    return pairs.agg(F.avg(similarity).alias("mean")).withColumn("passed", F.coalesce(F.col("mean") > above, F.lit(False)))


def principal_components(vectors: DataFrame, column: str, k: int = 2, id_column: str = "paper_id") -> DataFrame:
    """id, coordinates on the first components of the centred vectors, explained share of each. Signs are arbitrary.

    The covariance is summed in Spark from each partition's cross products; only D x D numbers meet.
    """
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    ready = vectors.select(id_column, array_to_vector(F.transform(column, lambda x: x.cast("double"))).alias("raw"))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="raw", outputCol="v").fit(ready).transform(ready)
    model = PCA(k=k, inputCol="v", outputCol="p").fit(centred)
    share = F.array(*[F.lit(float(x)) for x in model.explainedVariance])
    return model.transform(centred).select(id_column, vector_to_array("p").alias("coordinates"), share.alias("explained"))
