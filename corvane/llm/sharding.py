"""Best-fit-decreasing sharding of indivisible groups.

Rows with equal text form a group that no shard boundary may cut. Groups sorted by size, largest
first, enter the open shard whose remaining capacity is the tightest that still holds them; the
remaining capacities are kept in a balanced tree, so a step costs the logarithm of their number.
``smallest_capacity`` finds the least fixed capacity at which a given number of shards is enough,
``packed`` the number of shards that a given capacity needs.

Scale. Every group enters by its own size; none is bundled with others. Groups of one size are
interchangeable, and so are shards with the same room, so the sweep works on runs: a size with the
number of its groups, and a remaining capacity with an interval of shards. For that a size is rounded
up to SIZE_BITS significant bits (exact below 2**SIZE_BITS bytes, at most 0.013 % more beyond), so
there are at most 2**(SIZE_BITS - 1) sizes an octave: some 200,000 up to a terabyte, whatever the
number of documents and shards. That is what the driver gets. Rounded up, a shard never holds more
than its capacity. A run that meets a shard leaves it less than half its room, so a run of shards is
met at most as often as the capacity has bits. Groups then find their shard by their rank among those
of their size: they are counted and ranked in Spark, over hash buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, mapped, ranked

ROW_BYTES = 16  # each row weighs its UTF-8 bytes and this
SIZE_BITS = 13  # significant bits of a group's size, rounded up


class CapacityTree:
    """Ordered set of (remaining, first shard, shards) as an AVL tree: insert, take the tightest fit."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None

    def insert(self, key: tuple) -> None:
        self.root = _insert(self.root, key)

    def take_tightest(self, size: int) -> tuple | None:
        """Removes and returns the smallest member with ``remaining >= size``."""
        node, best = self.root, None
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        if best is not None:
            self.root = _remove(self.root, best)
        return best


def _node(key, left, right):
    return (key, left, right, 1 + max(left[3] if left else 0, right[3] if right else 0))


def _balanced(key, left, right):
    lean = (left[3] if left else 0) - (right[3] if right else 0)
    if lean > 1:
        k, a, b, _ = left
        if (a[3] if a else 0) >= (b[3] if b else 0):
            return _node(k, a, _node(key, b, right))
        return _node(b[0], _node(k, a, b[1]), _node(key, b[2], right))
    if lean < -1:
        k, a, b, _ = right
        if (b[3] if b else 0) >= (a[3] if a else 0):
            return _node(k, _node(key, left, a), b)
        return _node(a[0], _node(key, left, a[1]), _node(k, a[2], b))
    return _node(key, left, right)


def _insert(node, key):
    if node is None:
        return _node(key, None, None)
    if key < node[0]:
        return _balanced(node[0], _insert(node[1], key), node[2])
    return _balanced(node[0], node[1], _insert(node[2], key))


def _remove(node, key):
    k, left, right, _ = node
    if key < k:
        return _balanced(k, _remove(left, key), right)
    if key > k:
        return _balanced(k, left, _remove(right, key))
    if left is None or right is None:
        return left or right
    least = right
    while least[1] is not None:
        least = least[1]
    return _balanced(least[0], left, _remove(right, least[0]))


Run = tuple[int, int]  # a size, and how many groups have it


def packed(runs: list[Run], capacity: int, most: int | None = None) -> tuple[list[tuple[int, int, int, int]], int] | None:
    """Rows (size, first rank, groups a shard takes, first shard), and the shards opened; None beyond ``most``.

    ``runs`` come largest first. A row holds for the ranks of its size from its first one to the next
    row's: rank r enters the ``(r - first rank) // groups``-th shard from the first. A group larger
    than ``capacity`` gets a shard alone.
    """
    tree, opened, plan = CapacityTree(), 0, []
    for size, left in runs:
        rank = 0
        while left:
            found = tree.take_tightest(size)
            if found is None:
                each = max(1, capacity // size)
                count = -(-left // each)
                found, opened = (capacity, opened, count), opened + count
                if most is not None and opened > most:
                    return None
            free, first, count = found
            each = max(1, free // size)
            full, part = divmod(left, each)
            if full >= count:
                full, part = count, 0
            plan.append((size, rank, each, first))
            rest = count - full - bool(part)
            for room, start, n in ((free - each * size, first, full), (free - part * size, first + full, int(bool(part))), (free, first + full + bool(part), rest)):
                if n and room > 0:
                    tree.insert((room, start, n))
            taken = full * each + part
            left, rank = left - taken, rank + taken
    return plan, opened


def smallest_capacity(runs: list[Run], shards: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Packs into ``shards`` shards at the least capacity that is found by bisection.

    A group at least as large as the mean of what is left gets a shard alone, so that one hot
    group doesn't raise the capacity of the others.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    left, rest, plan, others = sum(s * n for s, n in runs), shards, [], list(runs)
    while others and rest > 1 and others[0][0] * rest >= left:
        size, count = others[0]
        known = plan and plan[-1][0] == size
        if not known:
            plan.append((size, 0, 1, shards - rest))
        left, rest = left - size, rest - 1
        others[0:1] = [(size, count - 1)] if count > 1 else []
    alone = shards - rest
    moved = {plan[-1][0]: alone - plan[-1][3]} if plan else {}  # ranks of a size that are placed already
    if not others:
        return plan, alone
    low = max(-(-left // rest), others[0][0])
    step, high, best = max(1, low >> 13), low, packed(others, low, rest)
    while best is None:
        low, high, step = high, high + step, step * 2
        best = packed(others, high, rest)
    while high - low > max(1, high >> 12):
        middle = (low + high) // 2
        found = packed(others, middle, rest)
        low, high, best = (middle, high, best) if found is None else (low, middle, found)
    more, opened = best
    return plan + [(size, rank + moved.get(size, 0), each, alone + first) for size, rank, each, first in more], alone + opened


def rounded_up(size: Column) -> Column:
    """The size with SIZE_BITS significant bits, upward."""
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - SIZE_BITS)
    step = F.pow(F.lit(2.0), shift).cast("long")
    return (F.ceil(size / step) * step).cast("long")


def shard_documents(docs: DataFrame, n_shards: int | None = 40, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs`` (columns doc_id and text).

    Either into ``n_shards`` of nearly equal size, or, with ``capacity`` (bytes), into as few shards of
    that capacity as best-fit decreasing needs; a shard exceeds it only if it holds one larger group
    alone. size: UTF-8 bytes of the text and ROW_BYTES; shard: from 0; slot: the row's place in its
    shard, from 0 without gaps. A null text counts as an empty one and shares its group; repeated rows
    keep one slot each; null ids are allowed; of groups of one size the order of their digests decides;
    an empty table gives an empty result; further columns are ignored.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = scratch.keep(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("_group"),
        )
    )
    held = rounded_up(F.col("_bytes"))
    if capacity is not None:
        held = F.when(F.col("_bytes") <= capacity, F.least(held, F.lit(capacity))).otherwise(held)
    groups = scratch.keep(rows.groupBy("_group").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")).select("_group", "_rows", held.alias("_held")))
    runs = [tuple(r) for r in groups.groupBy("_held").agg(F.count(F.lit(1)), F.sum("_rows")).collect()]  # bounded by SIZE_BITS
    runs.sort(reverse=True)
    sizes = [r[:2] for r in runs]
    plan, _ = smallest_capacity(sizes, n_shards) if capacity is None else packed(sizes, capacity)
    of_group = ranked(groups.select("_group", "_held"), ["_held"], ["_group"], "_rank", sum(r[1] for r in runs))
    shared = spark.sparkContext.broadcast(np.array(plan, np.int64).reshape(-1, 4))

    def place(frames):
        entries = shared.value
        order = np.lexsort((entries[:, 1], entries[:, 0]))
        entries = entries[order]
        for frame in frames:
            size, rank = (frame.column(c).to_numpy(zero_copy_only=False) for c in ("_held", "_rank"))
            own = entries[last_not_above(entries[:, 0], entries[:, 1], size, rank)]
            yield pa.RecordBatch.from_arrays([frame.column("_group"), pa.array((own[:, 3] + (rank - own[:, 1]) // own[:, 2]).astype(np.int32))], names=["_group", "shard"])

    found = scratch.keep(mapped(of_group, place, T.StructType([T.StructField("_group", T.BinaryType()), T.StructField("shard", T.IntegerType())])))
    scratch.drop(groups)
    placed = scratch.keep(rows.join(found, "_group").select("doc_id", "size", "text_crc32", "shard"))
    scratch.drop(rows, found)
    return ranked(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot", sum(r[2] for r in runs))


def last_not_above(keys: np.ndarray, firsts: np.ndarray, key: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of each (key, rank) the index of the last entry with that key whose first rank isn't above it; entries are sorted."""
    known, start = np.unique(keys, return_index=True)
    at = np.searchsorted(known, key)
    low, high = start[at], np.append(start, len(keys))[at + 1]
    while (wide := high - low > 1).any():
        middle = (low + high) // 2
        right = wide & (firsts[middle * wide] <= rank)
        low, high = np.where(right, middle, low), np.where(wide & ~right, middle, high)
    return low
