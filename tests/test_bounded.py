"""Search over blocks with bounds, against the search of whole rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import bounded, search
from corvane.plans import catalog

KIND = "paper_id string, title_embedding array<float>, abstract_embedding array<float>"


def hits(df):
    return [(r["paper_id"], round(r["score"], 9), r["rank"]) for r in df.orderBy("rank").collect()]


def corpus(spark, n, dim, seed, odd=True):
    r = np.random.default_rng(seed)
    some = r.normal(size=(max(2, n // 5), dim)) * np.geomspace(1, 0.01, dim)  # repeated, so that scores tie
    rows = [[f"p{i:04d}", some[r.integers(len(some))].tolist(), some[r.integers(len(some))].tolist()] for i in range(n)]
    if odd:
        rows += [["null", None, rows[0][1]], ["short", rows[0][1][:-1], rows[0][1]], ["nan", [float("nan")] * dim, rows[0][1]], ["zero", [0.0] * dim, [0.0] * dim], ["", [1.0] * dim, [-1.0] * dim], ["inf", [float("inf")] * dim, rows[0][1]]]
    return spark.createDataFrame(rows, KIND), r.normal(size=dim).tolist()


@pytest.mark.parametrize("dim,group", [(1, 4), (7, 3), (40, 16)])
@pytest.mark.parametrize("stored", [False, True])
def test_equals_search_of_whole_rows(spark, dim, group, stored):
    frame, q = corpus(spark, 300, dim, dim)
    frame = frame.where("paper_id <> 'inf'").repartition(3)
    ready = bounded.with_group_norms(frame, group=group) if stored else frame
    for k in (1, 9, 400):
        for metric in ("cosine", "dot", "euclidean"):
            assert hits(search.bounded_search(ready, q, k, "title", metric, group=group)) == hits(search.search(frame, q, k, "title", metric))
        assert hits(search.bounded_search(ready, q, k, "combined", group=group)) == hits(search.search_combined(frame, q, k))
    assert hits(search.bounded_search(ready, q, 400, "abstract", threshold=0.1, group=group)) == hits(search.search(frame, q, 400, "abstract", threshold=0.1))


def test_rows_are_left_early():
    """Long heads decide, so most of the tail is not multiplied; the best are those of all products."""
    r = np.random.default_rng(3)
    vectors = r.normal(size=(20_000, 512)) * np.geomspace(1, 0.001, 512)
    q = r.normal(size=512) * np.geomspace(1, 0.001, 512)
    starts = bounded.group_starts(512, 64)
    scorer, best = bounded.Scorer({"title": (q, 1.0)}, 10, "cosine", 64), bounded.Best(10)
    for at in range(0, len(vectors), 1000):
        some = vectors[at : at + 1000]
        scorer.block(best, list(range(at, at + len(some))), {"title": some}, {"title": bounded._norms(some, starts)})
    scores = vectors @ q / np.linalg.norm(vectors, axis=1) / np.linalg.norm(q)
    assert [i for _, i in best.rows] == np.argsort(-scores)[:10].tolist()
    assert scorer.finished < 0.4 * scorer.met


def test_faults_and_nothing(spark):
    frame, q = corpus(spark, 5, 4, 0, odd=False)
    with pytest.raises(ValueError):
        search.bounded_search(frame, [])
    assert hits(search.bounded_search(frame.limit(0), q)) == [] and hits(search.bounded_search(frame, q[:-1])) == []


def test_many_chunks_of_queries_are_written_and_forgotten(spark, monkeypatch):
    frame, _ = corpus(spark, 200, 8, 1, odd=False)
    queries = frame.select(F.col("paper_id").alias("query_id"), F.col("title_embedding").alias("q")).where("title_embedding is not null")
    destroyed = []
    from pyspark import Broadcast

    plain = Broadcast.destroy
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: destroyed.append(1) or plain(self, *a))
    want = {tuple(r) for r in search.multi_search(frame, queries, 3).collect()}
    assert not destroyed
    assert {tuple(r) for r in search.multi_search(frame, queries, 3, query_bytes=5000).collect()} == want and len(destroyed) > 3


@pytest.mark.parametrize("name", ["topk_bounded", "topk_bounded_combined"])
def test_registered(spark, name):
    assert catalog.queries()[name](spark, "/root/testdata/sf0.001").count() == 10
