"""Vector functions as Spark columns: double arithmetic over array<float>, safe for zero vectors.

Norms that are used more than once should be selected as columns first; the functions that take
norms exist for that.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v) -> Column:
    return F.sqrt(F.aggregate(_doubles(v), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine_of(product: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine from a dot product and norms; 0 where a vector is zero, null where one is null.

    The product and the norms stand once on the common path, so they are computed once.
    """
    scale = norm_a * norm_b
    return F.coalesce(F.try_divide(product, scale), F.when(scale == 0, F.lit(0.0)))


def cosine(a, b) -> Column:
    return cosine_of(dot(a, b), norm(a), norm(b))


def unit(v) -> Column:
    """The vector at length 1; a zero vector stays as it is."""
    length = norm(v)
    return F.when(length > 0, F.transform(_doubles(v), lambda x: x.cast("double") / length)).otherwise(F.transform(_doubles(v), lambda x: x.cast("double")))


def mean_of(a, b) -> Column:
    return F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x.cast("double") + y.cast("double")) / 2)


def abs_difference(a, b) -> Column:
    return F.zip_with(_doubles(a), _doubles(b), lambda x, y: F.abs(x.cast("double") - y.cast("double")))


def euclidean(a, b) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def element_mean(v) -> Column:
    return F.when(F.size(_doubles(v)) > 0, F.aggregate(_doubles(v), F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size(_doubles(v)))


def element_std(v) -> Column:
    """Population standard deviation of the elements."""
    mean = element_mean(v)
    return F.sqrt(F.aggregate(_doubles(v), F.lit(0.0), lambda s, x: s + (x.cast("double") - mean) * (x.cast("double") - mean)) / F.size(_doubles(v)))


def nan_count(v) -> Column:
    return F.size(F.filter(_doubles(v), lambda x: F.isnan(x)))


def zero_count(v) -> Column:
    return F.size(F.filter(_doubles(v), lambda x: x == 0))


def preview(v, n: int = 10, digits: int = 8) -> Column:
    """The first ``n`` elements as text with ``digits`` decimals, 8 at most, rounded as printf does: by the exact value, halves to the even digit.

    ``nan``, ``inf`` and ``-inf`` stand for what is no number. From 2**63 on, 17 digits are exact.
    """
    unit = 10.0**digits

    def text(x: Column) -> Column:
        size = F.abs(x)
        whole = F.when(size < 2.0**63, size).otherwise(0.0).cast("long")
        part = F.when(size < 2.0**63, size - whole.cast("double")).otherwise(0.0)
        high = part * 134217729.0 - (part * 134217729.0 - part)  # its upper 26 bits, so products with ``unit`` are exact
        scaled = part * unit
        missing = (high * unit - scaled) + (part - high) * unit  # what rounding took from ``scaled``
        half = scaled - F.floor(scaled) == 0.5
        near = F.floor(scaled) + F.when(half & (missing != 0), (missing > 0).cast("long")).otherwise(F.rint(scaled).cast("long") - F.floor(scaled))
        sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
        decimals = F.lpad(F.pmod(near, F.lit(int(unit))).cast("string"), digits, "0")
        plain = F.concat(sign, (whole + F.floor(near / unit)).cast("string"), F.lit("."), decimals)
        shown = F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf")
        return shown.when(size < 2.0**63, plain).when(x.isNotNull(), F.format_string(f"%.{digits}f", x))

    return F.transform(F.slice(_doubles(v), 1, n), lambda x: text(x.cast("double")))


def last_token_pool(states, mask) -> Column:
    """The state of the last token that the mask keeps, of array<array<float>> and array<int>."""
    last = F.array_max(F.transform(_doubles(mask), lambda m, i: F.when(m > 0, i + 1).otherwise(0)))
    return F.when(last > 0, F.try_element_at(_doubles(states), last))


def mean_pool(states, mask) -> Column:
    """The mean state of the tokens that the mask keeps; null if it keeps none."""
    kept = F.filter(_doubles(states), lambda s, i: F.get(_doubles(mask), i) > 0)
    zeros = F.transform(F.get(_doubles(states), F.lit(0)), lambda _: F.lit(0.0))
    total = F.aggregate(kept, zeros, lambda s, v: F.zip_with(s, v, lambda x, y: x + y.cast("double")))
    return F.when(F.size(kept) > 0, F.transform(total, lambda x: x / F.size(kept)))


METRICS = {"cosine": (cosine, True), "dot": (dot, True), "euclidean": (euclidean, False)}  # whether larger is nearer
