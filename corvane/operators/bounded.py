"""Exact top k over blocks of rows: groups of dimensions are scored one after the other, and bounds end rows early.

By Cauchy and Schwarz what a group of dimensions adds to a dot product is at most the product of the norms
of both parts. So after some groups a row's score is bounded by what it has and the rest's norms; a row that
cannot reach the partition's k-th score any more is left unfinished. Groups in which the query is long come
first. A partition holds one block and its k best; nothing else leaves it. Scores are doubles; ties go to
the smaller id, as in ``search``, and rows at the very bound are finished.

``with_group_norms`` stores the norms with the vectors, for corpora that are searched often; without them
they are computed on the way.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

GROUP, BLOCK_ROWS, SLACK = 256, 1024, 1e-9


def group_starts(dim: int, group: int = GROUP) -> np.ndarray:
    return np.arange(0, dim, group)


def _vectors(lists: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows that have a vector of ``dim`` numbers (the first one's length), those as a matrix, and the length."""
    starts, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    lengths = np.where(lists.is_null().to_numpy(zero_copy_only=False), -1, np.diff(starts))
    if dim is None:
        dim = int(lengths[lengths >= 0][0]) if (lengths >= 0).any() else 0
    at = np.flatnonzero(lengths == dim)
    if len(at) == len(lengths) and len(at):
        return at, flat[starts[0] : starts[-1]].reshape(len(at), dim), dim
    return at, flat[(starts[:-1][at][:, None] + np.arange(dim)).ravel()].reshape(len(at), dim), dim


def _norms(matrix: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if not matrix.shape[1]:
        return np.zeros((len(matrix), 0))
    return np.sqrt(np.add.reduceat(matrix.astype(np.float64) ** 2, starts, axis=1))


def with_group_norms(corpus: DataFrame, sides: Sequence[str] = ("title", "abstract"), group: int = GROUP) -> DataFrame:
    """The corpus with ``{side}_norms_{group}``: the norms of each vector's groups of ``group`` dimensions; null where there is no vector."""
    names = [f"{s}_norms_{group}" for s in sides]
    out = T.StructType([*corpus.drop(*names).schema.fields, *[T.StructField(n, T.ArrayType(T.DoubleType())) for n in names]])

    def work(frames):
        for frame in frames:
            added = []
            for s in sides:
                lists = frame.column(f"{s}_embedding")
                found: list = [None] * frame.num_rows
                for dim in {len(v) for v in lists if v.is_valid}:
                    at, matrix, _ = _vectors(lists, dim)
                    for i, n in zip(at.tolist(), _norms(matrix, group_starts(dim, group))):
                        found[i] = n
                added.append(pa.array(found, pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays([*frame.columns, *added], names=out.names)

    return corpus.drop(*names).mapInArrow(work, out)


class Best:
    """The k best (score, id) of a partition, larger scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def least(self) -> float:
        return self.rows[-1][0] if len(self.rows) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: list) -> None:
        both = [*self.rows, *zip(scores.tolist(), ids)]
        self.rows = sorted(both, key=lambda r: (-r[0], r[1] is not None, r[1]))[: self.k]


class Scorer:
    """Scores rows against one query a side: the weighted sum of cosines, or one dot product, or one distance."""

    def __init__(self, queries: dict[str, tuple[np.ndarray, float]], k: int, metric: str, group: int = GROUP):
        self.metric, self.k, self.group = metric, k, group
        self.queries = {s: (np.asarray(q, np.float64), w) for s, (q, w) in queries.items()}
        segments = []
        for side, (q, w) in self.queries.items():
            for at in group_starts(len(q), group).tolist():
                part = q[at : at + group]
                segments.append((float(np.linalg.norm(part)), side, at, part))
        self.segments = sorted(segments, key=lambda s: (-s[0], s[1], s[2]))  # where the query is long first
        self.finished = self.met = 0  # products with a group, and how many there would be without bounds

    def block(self, best: Best, ids: list, vectors: dict[str, np.ndarray], norms: dict[str, np.ndarray]) -> None:
        n = len(ids)
        scale, shift = {}, np.zeros(n)
        for side, (q, weight) in self.queries.items():
            whole = np.sqrt((norms[side] ** 2).sum(1))
            if self.metric == "cosine":
                length = whole * np.linalg.norm(q)
                scale[side] = np.divide(weight, length, out=np.where(np.isnan(length), np.nan, 0.0), where=length > 0)
            elif self.metric == "dot":
                scale[side] = np.ones(n)
            else:  # minus the squared distance
                scale[side], shift = np.full(n, 2.0), -(whole**2) - q @ q
        most = np.stack([length * norms[side][:, at // self.group] * np.abs(scale[side]) for length, side, at, _ in self.segments], 1)
        rest = np.concatenate([np.cumsum(most[:, ::-1], 1)[:, ::-1], np.zeros((n, 1))], 1)
        have, alive, size = shift.copy(), np.arange(n), rest[:, 0] + np.abs(shift)
        self.met += n * len(self.segments)
        for i, (_, side, at, part) in enumerate(self.segments):
            if best.least > -np.inf:
                alive = alive[~(have[alive] + rest[alive, i] + SLACK * size[alive] < best.least)]
            if not len(alive):
                return
            self.finished += len(alive)
            have[alive] += vectors[side][alive, at : at + self.group].astype(np.float64) @ part * scale[side][alive]
        scores = self._whole_scores({side: m[alive].astype(np.float64) for side, m in vectors.items()})
        good = np.flatnonzero(~np.isnan(scores))
        best.add(scores[good], [ids[j] for j in alive[good].tolist()])

    def _whole_scores(self, vectors: dict[str, np.ndarray]) -> np.ndarray:
        """Scores of finished rows, computed as ``search`` does: what was summed by groups only decides who is finished."""
        total = 0.0
        for side, (q, weight) in self.queries.items():
            v = vectors[side]
            if self.metric == "euclidean":
                return -((v - q) ** 2).sum(1)
            product = (v * q).sum(1)
            if self.metric == "dot":
                return product
            length = np.sqrt((v * v).sum(1)) * np.sqrt((q * q).sum())
            total = total + weight * np.divide(product, length, out=np.where(np.isnan(length), np.nan, 0.0), where=length > 0)
        return total


def best_of_partition(queries: dict[str, tuple[np.ndarray, float]], k: int, metric: str, group: int, stored: bool, out: T.StructType):
    """Maps rows (paper_id, each side's vector, and its group norms if they are stored) to the partition's k best."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind, sides = to_arrow_type(out["paper_id"].dataType), list(queries)

    def work(frames):
        scorer, best = Scorer(queries, k, metric, group), Best(k)
        for frame in frames:
            for first in range(0, frame.num_rows, BLOCK_ROWS):
                some = pa.Table.from_batches([frame.slice(first, BLOCK_ROWS)]).combine_chunks().to_batches()[0]
                found = {s: _vectors(some.column(1 + i), len(queries[s][0])) for i, s in enumerate(sides)}
                rows = found[sides[0]][0]
                for s in sides[1:]:
                    rows = np.intersect1d(rows, found[s][0])
                if not len(rows):
                    continue
                vectors = {s: m[np.searchsorted(at, rows)] if len(at) != len(rows) else m for s, (at, m, _) in found.items()}
                starts = {s: group_starts(m.shape[1], group) for s, m in vectors.items()}
                norms = {s: _vectors(some.column(1 + len(sides) + i).take(pa.array(rows)), len(starts[s]))[1] if stored else _norms(vectors[s], starts[s]) for i, s in enumerate(sides)}
                ids = some.column(0).to_pylist()
                scorer.block(best, [ids[j] for j in rows.tolist()], vectors, norms)
        scores = np.array([s for s, _ in best.rows])
        if metric == "euclidean":
            scores = np.sqrt(-scores)
        yield pa.RecordBatch.from_arrays([pa.array([i for _, i in best.rows], kind), pa.array(scores, pa.float64())], names=out.names)

    return work


def best_rows(corpus: DataFrame, queries: dict[str, tuple[Sequence[float], float]], k: int, metric: str = "cosine", group: int = GROUP) -> DataFrame:
    """paper_id, score of each partition's k best. ``queries``: of each side the query and its weight; several sides are for cosine.

    A null vector, or one of another length than the query's, is no hit, nor is a score that is no number;
    zero vectors score 0.
    """
    if not all(len(q) for q, _ in queries.values()) or len(queries) > 1 and metric != "cosine":
        raise ValueError("queries need values, and several sides the cosine")
    stored = all(f"{s}_norms_{group}" in corpus.columns for s in queries)
    out = T.StructType([T.StructField("paper_id", corpus.schema["paper_id"].dataType), T.StructField("score", T.DoubleType())])
    columns = ["paper_id", *[f"{s}_embedding" for s in queries], *([f"{s}_norms_{group}" for s in queries] if stored else [])]
    own = {s: (np.asarray(q, np.float64), w) for s, (q, w) in queries.items()}
    return corpus.select(*columns).mapInArrow(best_of_partition(own, k, metric, group, stored, out), out)
