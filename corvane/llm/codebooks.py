"""Compression of vectors to codes: a codebook for each of ``PARTS`` part positions, searched by ball trees.

Components become integers, floor(1024 x). Each part position has up to ``ENTRIES`` entries, which start as
that part of the vectors with the smallest ids; in each of ``ROUNDS`` rounds every part goes to its nearest
entry, and an entry becomes the componentwise floor of the mean of its parts. All distances are squared
Euclidean distances of integers, so results are exact and do not depend on how rows are dealt.

Search. The entries of a part position form a ball tree: a node holds a centre and the radius of its
entries around it, both in floating point, the radius rounded up. For a part at distance d of a centre no
entry of that ball is nearer than d - radius; a ball is left out only if this, rounded down, is greater
than the best distance so far, rounded up. Balls at the very bound are visited, as an entry with a lower
index may lie there. At a leaf the distances are compared as integers, equal ones by index. The nearer
child is searched first; a batch of parts goes down the tree together.

Scale. The integers are written once; each round is one pass over them. A task adds its parts up to one
row an entry (``PARTS * ENTRIES`` at most), those rows are added up by entry in a second stage, and the
driver gets the codebooks alone: ``ENTRIES`` times the dimension, 8 MB at 4,096. They travel back as a
broadcast of that size, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LONG, STRING, Scratch, mapped

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
LEAF = 16  # entries that a leaf holds at most
SLACK = 1e-9  # relative; covers the rounding of distances many times over
BATCH_VALUES = 1 << 20  # components that are searched together
_FAR = np.iinfo(np.int64).max
INTEGERS = T.ArrayType(LONG)


def largest_component(dim: int) -> int:
    """The largest integer component with which the error of a vector of ``dim`` components fits a long."""
    return math.isqrt((1 << 62) // max(1, dim)) // 2


class BallTree:
    """Nearest of some integer vectors: the index of the least squared distance, of equal ones the least index."""

    def __init__(self, entries: np.ndarray, leaf: int = LEAF):
        self.entries, self.floats, self.leaf = entries, entries.astype(np.float64), leaf
        self.squares, self.largest = (self.floats**2).sum(1), int(np.abs(entries).max(initial=0))
        self.root = self._node(np.arange(len(entries)))
        self.compared = 0  # parts with entries

    def _node(self, at: np.ndarray) -> tuple:
        points = self.floats[at]
        centre = points.mean(0)
        radius = float(np.sqrt(((points - centre) ** 2).sum(1)).max()) * (1 + SLACK)
        if len(at) <= self.leaf:
            return centre, radius, at, None, None
        widest = int(np.argmax(np.ptp(points, 0))) if points.shape[1] else 0
        order = at[np.argsort(points[:, widest], kind="stable")] if points.shape[1] else at
        half = len(order) // 2
        return centre, radius, None, self._node(np.sort(order[:half])), self._node(np.sort(order[half:]))

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row of ``parts`` (integers)."""
        self.parts, self.part_floats = parts, parts.astype(np.float64)
        largest = max(self.largest, int(np.abs(parts).max(initial=0)))
        self.exact = 4 * largest * largest * parts.shape[1] < 1 << 52  # then products in floating point are exact
        self.part_squares = (self.part_floats**2).sum(1)
        self.index, self.best, self.reach = np.full(len(parts), len(self.entries)), np.full(len(parts), _FAR), np.full(len(parts), np.inf)
        self._visit(self.root, np.arange(len(parts)), np.zeros(len(parts)))
        return self.index, self.best

    def _distances(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        self.compared += len(rows) * len(at)
        if self.exact:
            return (self.part_squares[rows, None] + self.squares[at] - 2 * (self.part_floats[rows] @ self.floats[at].T)).astype(np.int64)
        return np.stack([((self.parts[rows] - self.entries[e]) ** 2).sum(1) for e in at], 1)

    def _below(self, rows: np.ndarray, child: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Distances of the child's centre, and bounds that no entry below it is nearer than."""
        centre, radius = child[:2]
        distance = np.sqrt(((self.part_floats[rows] - centre) ** 2).sum(1))
        return distance, distance * (1 - SLACK) - radius

    def _visit(self, node: tuple, rows: np.ndarray, bounds: np.ndarray) -> None:
        rows = rows[bounds <= self.reach[rows]]
        if not len(rows):
            return
        _, _, at, left, right = node
        if at is not None:
            distances = self._distances(rows, at)
            first = np.argmin(distances, 1)  # of equal ones the first, and ``at`` ascends
            distance, index = distances[np.arange(len(rows)), first], at[first]
            better = (distance < self.best[rows]) | ((distance == self.best[rows]) & (index < self.index[rows]))
            rows = rows[better]
            self.best[rows], self.index[rows] = distance[better], index[better]
            self.reach[rows] = np.sqrt(self.best[rows].astype(np.float64)) * (1 + SLACK)
            return
        (to_left, bound_left), (to_right, bound_right) = self._below(rows, left), self._below(rows, right)
        near = to_left <= to_right
        self._visit(left, rows[near], bound_left[near])
        self._visit(right, rows[near], bound_right[near])
        self._visit(right, rows[~near], bound_right[~near])
        self._visit(left, rows[~near], bound_left[~near])


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, label, n, parts (floor(1024 x)) of the rows whose vector is there and holds finite numbers only."""
    out = T.StructType([vectors.schema["vec_id"], vectors.schema["label"], T.StructField("n", T.IntegerType()), T.StructField("parts", INTEGERS)])

    def work(frames):
        for frame in frames:
            lists = frame.column("embedding")
            whole = np.flatnonzero(~lists.is_null().to_numpy(zero_copy_only=False))
            starts, ends = lists.offsets.to_numpy()[:-1][whole], lists.offsets.to_numpy()[1:][whole]
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null becomes no number
            faults = np.append(0, np.cumsum(~np.isfinite(flat)))
            good = faults[ends] == faults[starts]
            whole, starts, lengths = whole[good], starts[good], (ends - starts)[good]
            place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            scaled = np.floor(flat[np.repeat(starts, lengths) + place] * SCALE)
            if len(scaled) and np.abs(scaled).max() > largest_component(int(lengths.max())):
                raise ValueError(f"components beyond {largest_component(int(lengths.max())) / SCALE} have errors that no long holds")
            values = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(scaled.astype(np.int64)))
            own = frame.take(pa.array(whole))
            yield pa.RecordBatch.from_arrays([own.column("vec_id"), own.column("label"), pa.array(lengths.astype(np.int32)), values], names=out.names)

    return mapped(vectors.select("vec_id", "label", "embedding"), work, out)


def _matrices(frames, dim: int):
    """Several batches as one, with the matrix of their parts."""
    held, rows = [], 0
    for frame in frames:
        held.append(frame)
        rows += frame.num_rows
        if rows * dim >= BATCH_VALUES:
            yield _matrix(held, dim)
            held, rows = [], 0
    if rows:
        yield _matrix(held, dim)


def _matrix(held: list, dim: int) -> tuple[pa.Table, np.ndarray]:
    whole = pa.Table.from_batches(held).combine_chunks()
    return whole, np.concatenate([c.flatten().to_numpy() for c in whole.column("parts").chunks]).reshape(-1, dim)


def _searched(shared, matrix: np.ndarray):
    """Of each part position the columns of ``matrix``, and the nearest entries with their squared distances."""
    trees = shared.value
    width = matrix.shape[1] // len(trees)
    for position, tree in enumerate(trees):
        own = matrix[:, position * width : (position + 1) * width]
        yield position, own, *tree.nearest(own)


SUMS = f"position int, entry int, n bigint, sums {INTEGERS.simpleString()}"


def _sums_batch(rows: dict[tuple[int, int], tuple[int, np.ndarray]]) -> pa.RecordBatch:
    keys = list(rows)
    columns = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([rows[k][0] for k in keys], pa.int64()), pa.array([rows[k][1] for k in keys], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, names=["position", "entry", "n", "sums"])


def entry_sums(kept: DataFrame, shared, dim: int) -> DataFrame:
    """position, entry, n, sums: the parts of each entry that has any, added up."""

    def own(frames):
        found: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        for _, matrix in _matrices(frames, dim):
            for position, part, index, _ in _searched(shared, matrix):
                order = np.argsort(index, kind="stable")
                used, first, counts = np.unique(index[order], return_index=True, return_counts=True)
                for entry, n, total in zip(used.tolist(), counts.tolist(), np.add.reduceat(part[order], first, axis=0)):
                    before = found.get((position, entry))
                    found[position, entry] = (n + before[0], total + before[1]) if before else (n, total)
        if found:
            yield _sums_batch(found)

    def together(frames):
        found: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        for frame in frames:
            for p, e, n, total in zip(*(frame.column(c).to_pylist() for c in ("position", "entry", "n")), frame.column("sums")):
                total, before = total.values.to_numpy(), found.get((p, e))
                found[p, e] = (n + before[0], total + before[1]) if before else (n, total.copy())
        if found:
            yield _sums_batch(found)

    return mapped(mapped(kept.select("parts"), own, SUMS).repartition("position", "entry"), together, SUMS)


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of all part positions after ``rounds`` rounds over ``integers``, a written table."""
    start = kept.orderBy(F.asc_nulls_last("vec_id"), "parts").limit(entries).select("parts").collect()  # a bounded number
    if not start:
        return []
    books = np.split(np.array([r["parts"] for r in start], np.int64), parts, axis=1)
    dim = parts * books[0].shape[1]
    for _ in range(rounds):
        shared = kept.sparkSession.sparkContext.broadcast([BallTree(b) for b in books])
        for row in entry_sums(kept, shared, dim).collect() if dim else []:  # parts * entries rows at most
            books[row["position"]][row["entry"]] = np.array(row["sums"], np.int64) // row["n"]
        shared.destroy()
    return books


def encode(kept: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error of ``integers`` by the codebooks."""
    dim = sum(b.shape[1] for b in books)
    shared = kept.sparkSession.sparkContext.broadcast([BallTree(b) for b in books])
    digits = max(2, len(f"{max(map(len, books)) - 1:x}"))
    hexes = np.array([f"{i:0{digits}x}" for i in range(max(map(len, books)))])
    out = T.StructType([kept.schema["vec_id"], kept.schema["label"], T.StructField("code", STRING), T.StructField("error", LONG)])

    def work(frames):
        for whole, matrix in _matrices(frames, dim) if dim else ((pa.Table.from_batches([f]), np.zeros((f.num_rows, 0), np.int64)) for f in frames):
            code, error = np.full(len(matrix), ""), np.zeros(len(matrix), np.int64)
            for _, _, index, distance in _searched(shared, matrix):
                code, error = np.char.add(code, hexes[index]), error + distance
            columns = [whole.column(c).combine_chunks() for c in ("vec_id", "label")]
            columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(code.tolist(), pa.string()), pa.array(error)], names=out.names)

    return mapped(kept.select("vec_id", "label", "parts"), work, out)


def books_sha256(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part position, entry and place, comma-joined."""
    digest, lead = hashlib.sha256(), ""
    for book in books:
        for entry in book.tolist():
            if entry:
                digest.update((lead + ",".join(map(str, entry))).encode())
                lead = ","
    return digest.hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code, error of every kept row of ``vectors`` (vec_id, embedding, label), and the codebooks.

    A row whose vector is null, or holds a null or a component that is not finite, is left out. Vectors
    must have one length, a multiple of ``parts`` (an empty one has distance 0), and components whose
    errors fit a long (``largest_component``); others are a ValueError. Rows that repeat an id are each kept;
    the start takes rows by id, then by vector, null ids last. With fewer rows than ``entries`` the codebooks
    have as many entries as rows, with no rows none. Equal distances go to the lower index. Further columns
    are ignored.
    """
    scratch = Scratch(vectors.sparkSession)
    kept = scratch.keep(integers(vectors))
    least, most = kept.agg(F.min("n"), F.max("n")).first()
    if least != most or (least or 0) % parts:
        raise ValueError(f"vectors of {least} to {most} components cannot be cut into {parts} equal parts")
    books = train(kept, parts, entries, rounds)
    coded = encode(kept, books) if books else kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    made = scratch.keep(coded)
    scratch.drop(kept)
    return made, books


def digest(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of the rows that ``compress`` keeps; nulls as there.

    ``label_error`` adds the errors of all rows with that label, those without a label together.
    """
    made, books = compress(vectors)
    sums = Scratch(vectors.sparkSession).keep(made.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("_label"), "label_error"))
    joined = made.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
