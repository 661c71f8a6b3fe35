"""Agreement of vectors that several backends made of the same texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vector as V


def grade(similarity: Column) -> Column:
    return F.when(similarity > 0.99, "high").when(similarity > 0.95, "similar").otherwise("different")


def agreement(vectors: DataFrame) -> DataFrame:
    """text_id, backend_a, backend_b, similarity, grade, mean/largest/std of the absolute difference.

    ``vectors`` has text_id, backend, v; each pair of a text's backends once.
    """
    a, b = (vectors.select("text_id", F.col("backend").alias(f"backend_{s}"), F.col("v").alias(f"v_{s}")) for s in "ab")
    pairs = a.join(b, "text_id").where("backend_a < backend_b").withColumn("difference", V.abs_difference("v_a", "v_b"))
    similarity = V.cosine("v_a", "v_b")
    return pairs.select("text_id", "backend_a", "backend_b", similarity.alias("similarity"), grade(similarity).alias("grade"), V.element_mean("difference").alias("mean_difference"), F.array_max("difference").alias("max_difference"), V.element_std("difference").alias("std_difference"))


def difference_table(pairs: DataFrame, a: str, b: str, n: int = 50) -> DataFrame:
    """The first ``n`` dimensions side by side: the pair's other columns, dim, a, b, difference."""
    others = [c for c in pairs.columns if c not in (a, b)]
    cut = F.arrays_zip(F.slice(a, 1, n).alias("a"), F.slice(b, 1, n).alias("b"))
    flat = pairs.select(*others, F.posexplode(cut).alias("dim", "e"))
    x, y = F.col("e.a").cast("double"), F.col("e.b").cast("double")
    return flat.select(*others, "dim", x.alias("a"), y.alias("b"), F.abs(x - y).alias("difference"))
