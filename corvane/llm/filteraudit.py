"""How filters interact: survivors for every order of them, and each one's Shapley value.

Every document gets a mask of the filters that it fails. A part's counts by mask are the whole input of
the audit. They form its removal polynomial, the multilinear extension of "how many documents does this
set of filters remove":

    f(x) = sum over masks m of  count(m) * (1 - product over i in m of (1 - x_i))
         = sum over sets T of   a(T) * product over i in T of x_i,     a(T) = (-1)^(|T|+1) * sum of count(m) over m that hold T

At a corner (x_i = 1 for the filters of a set S, else 0) its value is what S removes, so the corners along an
order give that order's survivors. A filter's Shapley value is the integral of df/dx_i along the diagonal
x = (t, .., t) from 0 to 1: each a(T) with i in T adds a(T) / |T|, an exact rational. Scaled by the number of
orders (5! = 120) it is whole, and equals what the filter removes, summed over all orders.

Scale. A text is read once, and becomes a mask and a digest of 32 bytes. Two shuffles of such narrow rows
follow (labels by document, copies by digest); counts are combined before every shuffle, so neither a
frequent text nor a part with a third of all rows is a hot task. What the polynomials are formed from is
a row a part, and the 600 rows of a part come from that one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from fractions import Fraction
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LONG, STRING, Scratch, mapped

FILTERS = "ABCDE"  # the order of the mask's bits
COPY = FILTERS.index("E")  # the one filter that no text decides by itself
FEW_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
_CAPITALS, _MARKS, _CONTINUED = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))


def text_mask(text: bytes) -> int:
    """The filters A to D that a text (UTF-8) fails, as bits."""
    words = text.split()  # of bytes: at space, tab, line feed, vertical tab, form feed, carriage return
    n = len(words)
    points = len(text) - _occurrences(text, _CONTINUED)
    return (
        (n < FEW_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1
        | (100 * _occurrences(text, _CAPITALS) > CAPITAL_PERCENT * points) << 2
        | (_occurrences(text, _MARKS) > 0) << 3
    )


def _occurrences(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


def judged(docs: DataFrame, masks: Callable[[bytes], int] = text_mask) -> DataFrame:
    """doc_id, part, mask (of the filters that look at one text), digest (SHA-256) of every row of ``docs``."""
    out = T.StructType([docs.schema["doc_id"], T.StructField("part", STRING), T.StructField("mask", T.IntegerType()), T.StructField("digest", T.BinaryType())])

    def work(frames):
        for frame in frames:
            texts = frame.column("text").to_pylist()
            found = [pa.array([masks(t) for t in texts], pa.int32()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), frame.column("part"), *found], names=out.names)

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return mapped(docs.select("doc_id", text, F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")), work, out)


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, all, good, toxic: counts by mask (arrays, the mask as the place) of all rows, of good and of toxic ones."""
    scratch = Scratch(docs.sparkSession)
    flags = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = scratch.keep(judged(docs).join(flags, "doc_id", "left").select("doc_id", "part", "mask", "digest", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    both = rows.join(first, ["digest", "doc_id"], "left").select("part", "good", "toxic", (F.col("mask") + F.when(copy, 1 << COPY).otherwise(0)).alias("mask"))
    counted = both.groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    kinds = [("all", F.lit(True)), ("good", F.col("good") == 1), ("toxic", F.col("toxic") == 1)]
    sums = [F.sum(F.when((F.col("mask") == m) & kind, F.col("n")).otherwise(0)).alias(f"{name}{m}") for name, kind in kinds for m in range(1 << len(FILTERS))]
    out = counted.groupBy("part").agg(*sums).select("part", *[F.array(*[f"{name}{m}" for m in range(1 << len(FILTERS))]).alias(name) for name, _ in kinds])
    made = scratch.keep(out)
    scratch.drop(rows)
    return made



class Removal:
    """The removal polynomials of several parts, of counts by mask (a row a part)."""

    def __init__(self, counts: np.ndarray, filters: int):
        self.filters = filters
        self.total = counts.sum(1)
        holding = counts.astype(np.int64).copy()  # becomes the sum of the counts of all masks that hold T
        sets = np.arange(1 << filters)
        for i in range(filters):
            without = sets[sets >> i & 1 == 0]
            holding[:, without] += holding[:, without | 1 << i]
        size = np.bitwise_count(sets)
        self.coefficients = np.where(size % 2 == 1, holding, -holding)
        self.coefficients[:, 0] = 0
        self.corners = self.coefficients.copy()  # becomes the value at each corner: the sum over the subsets of S
        for i in range(filters):
            within = sets[sets >> i & 1 == 1]
            self.corners[:, within] += self.corners[:, within ^ 1 << i]

    def removed(self, chosen: int) -> np.ndarray:
        """What a set of filters (bits) removes: the polynomial at that corner."""
        return self.corners[:, chosen]

    def shapley(self, i: int) -> np.ndarray:
        """The integral of the partial derivative along the diagonal, times the number of orders: whole numbers."""
        out = np.zeros(len(self.coefficients), np.int64)
        for degree in range(1, self.filters + 1):
            integral = Fraction(1, degree) * factorial(self.filters)  # of t^(degree - 1) from 0 to 1
            assert integral.denominator == 1
            sets = [t for t in range(1 << self.filters) if t >> i & 1 and t.bit_count() == degree]
            out += integral.numerator * self.coefficients[:, sets].sum(1)
        return out


MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
OUT = T.StructType([T.StructField("part", STRING), T.StructField("filter_order", STRING), T.StructField("step", T.IntegerType()), *[T.StructField(m, LONG) for m in MEASURES]])


def orders(counts: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """part, filter_order, step and MEASURES for every order of the filters, from ``mask_counts``."""
    n, every = len(filters), (1 << len(filters)) - 1
    steps = []  # order, step, filter, the filters before
    for order in permutations(range(n)):
        before = 0
        for step, i in enumerate(order):
            steps.append(("".join(filters[k] for k in order), step + 1, i, before))
            before |= 1 << i
    names, numbers = [s[0] for s in steps], [s[1] for s in steps]
    i, before = (np.array([s[k] for s in steps]) for k in (2, 3))

    def work(frames):
        for frame in frames:
            for at in range(0, frame.num_rows, 64):
                some = frame.slice(at, 64)
                kinds = [Removal(np.array(some.column(c).to_pylist(), np.int64).reshape(-1, 1 << n), n) for c in ("all", "good", "toxic")]
                after = before | 1 << i
                lost = [k.removed(after) - k.removed(before) for k in kinds]
                own = kinds[0]
                fails, alone = own.removed(1 << i), own.removed(np.full(len(i), every)) - own.removed(every ^ 1 << i)
                shapley = np.stack([own.shapley(k) for k in range(n)], 1)[:, i]
                values = [own.total[:, None] - own.removed(after), lost[0], fails - lost[0], alone, lost[1], lost[2], shapley]
                parts = some.num_rows
                columns = [pa.array(np.repeat(np.array(some.column("part").to_pylist(), object), len(steps)).tolist(), pa.string()), pa.array(names * parts, pa.string()), pa.array(numbers * parts, pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(v.ravel()) for v in values]], names=OUT.names)

    return mapped(counts, work, OUT)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    600 rows for each source of ``docs`` (doc_id, text, source), null and empty ones together as the part
    "". A null text counts as an empty one, which fails A alone (and E, if a smaller id has one too); texts
    are read whole. Rows that repeat an id are each counted, and are copies only of smaller ids; a row without
    an id is no copy, has none and no labels. A document with several ``labels`` is good, or toxic, if one of
    them says so. An empty table has no parts and gives no rows; further columns are ignored.
    """
    return orders(mask_counts(docs, labels))
