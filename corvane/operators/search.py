"""Exact nearest-neighbour search over title and abstract vectors.

Corpora have paper_id, title_embedding, abstract_embedding, row_index. A query is one vector, given
as a Python list or a one-row frame with a column ``q``. Scores are doubles; ties go to the smaller
paper_id. All searches end in a bounded top-k, so Spark keeps k rows a partition and merges those:
nothing is sorted whole. ``prepare`` selects norms once, for corpora that are searched often.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import vector as V
from ..session import shared_folder
from . import bounded

TITLE_WEIGHT, ABSTRACT_WEIGHT = 0.3, 0.7
OVERFETCH = 3
Query = Sequence[float] | DataFrame


def prepare(corpus: DataFrame) -> DataFrame:
    """Adds title_norm and abstract_norm, which every cosine needs."""
    return corpus.withColumns({"title_norm": V.norm("title_embedding"), "abstract_norm": V.norm("abstract_embedding")})


def _with_query(corpus: DataFrame, query: Query) -> DataFrame:
    """The corpus with the columns q and q_norm of the one query."""
    if isinstance(query, DataFrame):
        one = query.select("q").limit(1).withColumn("q_norm", V.norm("q"))
        return corpus.crossJoin(F.broadcast(one))  # one row
    return corpus.withColumns({"q": F.array(*[F.lit(float(x)) for x in query]), "q_norm": F.lit(float(np.linalg.norm(np.asarray(query, float))))})


def _cosine(frame: DataFrame, side: str) -> Column:
    have = frame.columns
    found = V.cosine_of(V.dot(f"{side}_embedding", "q"), F.col(f"{side}_norm") if f"{side}_norm" in have else V.norm(f"{side}_embedding"), F.col("q_norm"))
    return F.when(F.size(f"{side}_embedding") == F.size("q"), found)  # a vector of another length is no hit, not even an empty one


def ranked(hits: DataFrame, k: int, nearest_first: bool = True, threshold: float | None = None) -> DataFrame:
    """paper_id, score, rank of the k best; nulls and what is no number never are hits.

    Nulls and scores beyond the threshold sort last, so they are dropped from the k best: a filter
    before would be pushed below the projection and compute every score twice.
    """
    hits = hits.withColumn("score", F.nanvl("score", F.lit(None).cast("double")))
    order = F.desc_nulls_last("score") if nearest_first else F.asc_nulls_last("score")
    best = hits.orderBy(order, "paper_id").limit(k).where("score is not null")
    if threshold is not None:
        best = best.where(F.col("score") >= threshold if nearest_first else F.col("score") <= threshold)
    order = Window.orderBy(order, "paper_id")
    return best.withColumn("rank", F.row_number().over(order))  # over k rows


def bounded_search(corpus: DataFrame, query: Sequence[float], k: int = 10, side: str = "title", metric: str = "cosine", threshold: float | None = None, group: int = bounded.GROUP) -> DataFrame:
    """As ``search``, over Arrow blocks with bounds (``bounded``): for vectors of many dimensions. ``side`` may be ``combined`` too, with the weights of ``search_combined``."""
    if side == "combined":
        found = bounded.best_rows(corpus, {"title": (query, TITLE_WEIGHT), "abstract": (query, ABSTRACT_WEIGHT)}, k, group=group)
    else:
        found = bounded.best_rows(corpus, {side: (query, 1.0)}, k, metric, group)
    return ranked(found, k, V.METRICS[metric][1], threshold)


def search(corpus: DataFrame, query: Query, k: int = 10, side: str = "title", metric: str = "cosine", threshold: float | None = None) -> DataFrame:
    """The k nearest by one side; ``threshold`` drops lower scores (higher distances)."""
    frame = _with_query(corpus, query)
    function, larger = V.METRICS[metric]
    score = _cosine(frame, side) if metric == "cosine" else function(f"{side}_embedding", "q")
    return ranked(frame.select("paper_id", score.alias("score")), k, larger, threshold)


def search_combined(corpus: DataFrame, query: Query, k: int = 10, title_weight: float = TITLE_WEIGHT, abstract_weight: float = ABSTRACT_WEIGHT) -> DataFrame:
    """Weighted sum of both cosines over all rows."""
    frame = _with_query(corpus, query)
    return ranked(frame.select("paper_id", (_cosine(frame, "title") * title_weight + _cosine(frame, "abstract") * abstract_weight).alias("score")), k)


def search_candidates(corpus: DataFrame, query: Query, k: int = 10, title_weight: float = TITLE_WEIGHT, abstract_weight: float = ABSTRACT_WEIGHT, overfetch: int = OVERFETCH) -> DataFrame:
    """Weighted sum over the best ``overfetch * k`` of each side; a side that lacks a candidate counts 0."""
    frame = _with_query(corpus, query)

    def side(name: str, weight: float) -> DataFrame:
        hits = frame.select("paper_id", F.nanvl(_cosine(frame, name), F.lit(None).cast("double")).alias("score")).orderBy(F.desc_nulls_last("score"), "paper_id")
        return hits.limit(overfetch * k).where("score is not null").select("paper_id", (F.col("score") * weight).alias("part"))

    both = side("title", title_weight).unionAll(side("abstract", abstract_weight))
    return ranked(both.groupBy("paper_id").agg(F.sum("part").alias("score")), k)


def search_mean(corpus: DataFrame, query: Query, k: int = 10) -> DataFrame:
    """Cosine of the mean of both vectors, which are not scaled before."""
    frame = _with_query(corpus.withColumn("mean_embedding", V.mean_of("title_embedding", "abstract_embedding")), query)
    return ranked(frame.select("paper_id", _cosine(frame, "mean").alias("score")), k)


def similar_to(corpus: DataFrame, paper_id: str, k: int = 10, side: str = "title") -> DataFrame:
    """The k nearest of a stored paper, itself included; no rows if the id is unknown."""
    query = corpus.where(F.col("paper_id") == paper_id).select(F.col(f"{side}_embedding").alias("q"))
    return search(corpus, query, k, side)


QUERY_BYTES = 64 << 20  # of queries that one scan of the corpus takes along


def multi_search(corpus: DataFrame, queries: DataFrame, k: int = 10, side: str = "title", block: int = 256, metric: str = "cosine", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, paper_id, score, rank for many queries (query_id, q), of any id types.

    One scan of the corpus takes up to ``query_bytes`` of queries along and scores them ``block`` at a
    time; more queries take more scans, one after the other: the best of each are written to the shared folder and
    its queries forgotten before the next are fetched, so the driver holds ``query_bytes`` at a time, however
    many there are. A partition keeps its k best of each query, and only those are
    shuffled. As in ``search``, a null vector or one of another length than the query's is no hit, nor is a
    score that isn't a number; zero vectors score 0; ties go to the smaller paper_id. A query without a
    vector has no hits.
    """
    spark = corpus.sparkSession
    asked = queries.where("query_id is not null and q is not null and size(q) > 0").select("query_id", F.transform("q", lambda x: x.cast("double")).alias("q"))
    kinds = {"query_id": queries.schema["query_id"].dataType, "paper_id": corpus.schema["paper_id"].dataType}
    out = T.StructType([*[T.StructField(n, t) for n, t in kinds.items()], T.StructField("score", T.DoubleType())])
    ready = corpus.select("paper_id", F.transform(f"{side}_embedding", lambda x: x.cast("double")).alias("v")).where("paper_id is not null and v is not null")

    def best(shared) -> DataFrame:
        return ready.mapInArrow(_best_of_partition(shared, k, block, metric, out), out)

    made = _chunks(asked.toLocalIterator(), query_bytes)
    first, second = next(made, None), next(made, None)
    if first is None:
        return spark.createDataFrame([], T.StructType([*out.fields, T.StructField("rank", T.IntegerType())]))
    if second is None:  # one scan, which runs when the result is read
        found = best(spark.sparkContext.broadcast(first))
    else:
        path = f"{shared_folder(spark)}/corvane-hits-{uuid.uuid4().hex}"
        for some in itertools.chain((first, second), made):
            first = second = None
            shared = spark.sparkContext.broadcast(some)
            best(shared).write.mode("append").parquet(path)
            shared.destroy()
        found = spark.read.schema(out).parquet(path)
    order = Window.partitionBy("query_id").orderBy(F.desc("score") if V.METRICS[metric][1] else F.asc("score"), "paper_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _chunks(rows: Iterator, most: int) -> Iterator[dict[int, tuple[list, np.ndarray]]]:
    """Length of vector -> ids and matrix of the queries of that length, up to ``most`` bytes at once."""
    held, size = {}, 0
    for r in rows:
        held.setdefault(len(r["q"]), []).append((r["query_id"], [np.nan if x is None else x for x in r["q"]]))
        size += 8 * len(r["q"]) + 64
        if size >= most:
            yield _matrices(held)
            held, size = {}, 0
    if held:
        yield _matrices(held)


def _matrices(held: dict) -> dict[int, tuple[list, np.ndarray]]:
    return {n: ([i for i, _ in some], np.array([q for _, q in some], np.float64)) for n, some in held.items()}


def _scores(vectors: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """A row a query; larger is nearer."""
    if metric == "euclidean":
        return -np.stack([np.linalg.norm(vectors - q, axis=1) for q in queries])
    products = queries @ vectors.T
    if metric == "dot":
        return products
    scale = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :]
    return np.divide(products, scale, out=np.where(np.isnan(scale), np.nan, 0.0), where=scale > 0)


def _best_of_partition(shared, k: int, block: int, metric: str, out: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in out]

    def work(frames):
        queries = shared.value
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}  # (length, first query of the block) -> scores and ids, a row a query
        for frame in frames:
            names = np.array([*frame.column(0).to_pylist(), None], dtype=object)[:-1]
            lists = frame.column(1)
            starts, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            lengths = np.diff(starts)
            for n, (_, matrix) in queries.items():
                at = np.flatnonzero(lengths == n)
                if not len(at):
                    continue
                vectors = flat[(starts[at][:, None] + np.arange(n)).ravel()].reshape(len(at), n)
                for first in range(0, len(matrix), block):
                    scores = _scores(vectors, matrix[first : first + block], metric)
                    own = np.broadcast_to(names[at], scores.shape)
                    if (n, first) in best:
                        scores, own = np.concatenate([best[n, first][0], scores], 1), np.concatenate([best[n, first][1], own], 1)
                    scores = np.where(np.isnan(scores), -np.inf, scores)  # sorts last, and is left out below
                    order = np.stack([_first_k(s, i, k) for s, i in zip(scores, own)])
                    best[n, first] = np.take_along_axis(scores, order, 1), np.take_along_axis(own, order, 1)
        for (n, first), (scores, own) in best.items():
            ids = np.array([*queries[n][0][first : first + block], None], dtype=object)[:-1]
            good = (scores > -np.inf).ravel()
            columns = np.repeat(ids, scores.shape[1])[good], own.ravel()[good], (scores if V.METRICS[metric][1] else -scores).ravel()[good]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names=out.names)

    return work


def _first_k(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best, ties by id: only those that reach the k-th score are sorted."""
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return near[np.lexsort((ids[near], -scores[near]))][:k]
    return np.lexsort((ids, -scores))


def search_parts(title: DataFrame, abstract: DataFrame, query: Query, k: int = 10, side: str = "title") -> DataFrame:
    """The k nearest over numbered parts (part, pos, paper_id, embedding) of both sides, as one corpus.

    Parts whose sides don't agree are left out, as ``zip_parts`` does.
    """
    from ..sources.stores import zip_parts

    return search(zip_parts(title, abstract), query, k, side)


def with_metadata(hits: DataFrame, papers: DataFrame, fields: Sequence[str] = ("title", "abstract", "authors", "categories", "doi", "journal_ref", "update_date")) -> DataFrame:
    """Hits with the fields of their paper, empty where there is none. Hits are few: papers are scanned once."""
    some = papers.select(F.col("id").alias("_id"), *fields)
    joined = some.join(F.broadcast(hits), some["_id"] == hits["paper_id"], "right")  # k rows
    return joined.select(*hits.columns, *[F.coalesce(f, F.lit("")).alias(f) for f in fields])


def lookup(corpus: DataFrame, paper_id: str) -> DataFrame:
    """paper_id, row_index and the sizes of both vectors of one paper."""
    return corpus.where(F.col("paper_id") == paper_id).select("paper_id", "row_index", F.size("title_embedding").alias("title_dim"), F.size("abstract_embedding").alias("abstract_dim"))


def lookup_index(corpus: DataFrame, row_index: int) -> DataFrame:
    """The same by place; no rows beyond the end."""
    return corpus.where(F.col("row_index") == row_index).select("paper_id", "row_index", F.size("title_embedding").alias("title_dim"), F.size("abstract_embedding").alias("abstract_dim"))
