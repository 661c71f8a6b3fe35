import io
import json
import math
import urllib.error
import zipfile
from xml.etree import ElementTree

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.functions import text as X
from corvane.functions import vector as V
from corvane.operators import collection, compare, embed, merge, profile, quality, reconcile, sampling, search
from corvane.sources import sinks, stores
from corvane.streaming import incremental


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [("a", [1.0, 0.0], [0.0, 1.0], 0), ("b", [1.0, 0.0], [1.0, 0.0], 1), ("z", [0.0, 0.0], [0.0, 0.0], 2), ("c", [-1.0, 0.0], [0.6, 0.8], 3)]
    return spark.createDataFrame(rows, "paper_id string, title_embedding array<float>, abstract_embedding array<float>, row_index long")


def hits(df):
    return [(r["paper_id"], round(r["score"], 6), r["rank"]) for r in df.orderBy("rank").collect()]


def test_zero_vectors_score_zero_and_ties_go_by_id(corpus):
    assert hits(search.search(corpus, [2.0, 0.0], 10)) == [("a", 1.0, 1), ("b", 1.0, 2), ("z", 0.0, 3), ("c", -1.0, 4)]
    assert hits(search.search(search.prepare(corpus), [2.0, 0.0], 2)) == [("a", 1.0, 1), ("b", 1.0, 2)]
    assert hits(search.search(corpus, [0.0, 0.0], 1)) == [("a", 0.0, 1)]


def test_both_kinds_of_combined_search(corpus):
    assert hits(search.search_combined(corpus, [1.0, 0.0], 2)) == [("b", 1.0, 1), ("a", 0.3, 2)]
    near = hits(search.search_candidates(corpus, [1.0, 0.0], 1, overfetch=1))
    assert near == [("b", 0.7, 1)]  # its title lost the tie against a, so that side counts 0
    assert hits(search.similar_to(corpus, "nobody")) == []


def test_many_queries_equal_single_ones(spark, corpus):
    queries = corpus.select(F.col("paper_id").alias("query_id"), F.col("title_embedding").alias("q"))
    for block in (1, 2, 10):
        found = search.multi_search(corpus.repartition(3), queries, 2, "abstract", block)
        for q in queries.collect():
            assert hits(found.where(F.col("query_id") == q["query_id"])) == hits(search.search(corpus, list(q["q"]), 2, "abstract"))


def test_nulls_and_what_is_no_number_are_no_hits_in_any_search(spark):
    nan = float("nan")
    rows = [("a", [1.0, 0.0], 0), ("b", None, 1), ("c", [nan, 1.0], 2), ("d", [0.0, 2.0], 3), ("e", [1.0], 4), ("f", [0.0, 0.0], 5), (None, [1.0, 0.0], 6), ("g", [], 7)]
    corpus = spark.createDataFrame(rows, "paper_id string, title_embedding array<float>, row_index long").withColumn("abstract_embedding", F.col("title_embedding"))
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0]), (4, [nan, 0.0]), (5, [2.0]), (None, [1.0, 0.0])], "query_id int, q array<float>")
    want = {1: [("a", 1.0), ("d", 0.0), ("f", 0.0)], 3: [("d", 1.0), ("a", 0.0), ("f", 0.0)], 5: [("e", 1.0)]}
    for parts, k, size in ((1, 3, 64 << 20), (4, 3, 1), (1, 10, 64 << 20), (4, 10, 1)):
        found = search.multi_search(corpus.repartition(parts), queries, k, query_bytes=size).orderBy("query_id", "rank").collect()
        got = {}
        for r in found:
            got.setdefault(r["query_id"], []).append((r["paper_id"], r["score"]))
        assert got == want
    named = corpus.where("paper_id is not null")
    for metric, best in (("cosine", ["a", "d", "f"]), ("dot", ["a", "d", "f"]), ("euclidean", ["a", "f", "d"])):
        one = [r["paper_id"] for r in search.search(named, [1.0, 0.0], 10, metric=metric).orderBy("rank").collect()]
        many = [r["paper_id"] for r in search.multi_search(named, queries.where("query_id = 1"), 10, metric=metric).orderBy("rank").collect()]
        assert one == many == best
    assert [h[0] for h in hits(search.search_combined(named, [1.0, 0.0], 10))] == ["a", "d", "f"] == [h[0] for h in hits(search.search_candidates(named, [1.0, 0.0], 10))]


def test_dimension_statistics_of_uneven_vectors(spark):
    r = np.random.default_rng(2)
    vectors = [r.normal(size=int(n)).tolist() for n in r.integers(0, 6, 300)] + [None]
    found = quality.dimension_stats(spark.createDataFrame([(v,) for v in vectors], "v array<double>").repartition(5), "v").orderBy("dim").collect()
    for d, row in enumerate(found):
        x = np.array([v[d] for v in vectors if v and len(v) > d])
        assert row["dim"] == d + 1 and np.allclose([row["mean"], row["std"], row["least"], row["largest"]], [x.mean(), x.std(), x.min(), x.max()])
    assert len(found) == 5


def test_metadata_of_hits(spark, corpus):
    papers = spark.createDataFrame([("a", "T")], "id string, title string")
    rows = search.with_metadata(search.search(corpus, [1.0, 0.0], 2), papers, ("title",)).orderBy("rank").collect()
    assert [(r["paper_id"], r["title"]) for r in rows] == [("a", "T"), ("b", "")]


def test_pooling(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0], [9.0, 9.0]], [1, 1, 0]), ([[1.0, 2.0], [3.0, 4.0], [9.0, 9.0]], [0, 0, 0])], "s array<array<float>>, m array<int>")
    rows = df.select(V.last_token_pool("s", "m").alias("last"), V.mean_pool("s", "m").alias("mean")).collect()
    assert rows[0]["last"] == [3.0, 4.0] and rows[0]["mean"] == [2.0, 3.0] and rows[1]["last"] is None and rows[1]["mean"] is None


def test_integrity_counts_each_fault(spark):
    rows = [("a", [1.0, float("nan")], [1.0, 1.0], 0), ("a", [1.0], [1.0, 1.0], 1), ("b", None, [1.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "paper_id string, title_embedding array<float>, abstract_embedding array<float>, row_index long")
    found = {r["check"]: (r["value"], r["ok"]) for r in quality.integrity(df).collect()}
    assert found["duplicate_ids"] == (1, False) and found["title_embedding_missing"] == (1, False) and found["title_embedding_dims"] == (1, False)
    assert found["title_embedding_nan_rows"] == (1, False) and found["abstract_embedding_nan_rows"] == (0, True) and found["dims_between_sides"] == (1, False)
    assert {r["check"]: r["value"] for r in quality.integrity(df, nan_rows=0).collect()}["title_embedding_nan_rows"] == 0


def test_principal_components_explain_the_spread(spark):
    r = np.random.default_rng(0)
    rows = [(str(i), [float(a), float(2 * a + b), float(c)]) for i, (a, b, c) in enumerate(zip(r.normal(size=200), r.normal(0, 0.1, 200), r.normal(0, 0.1, 200)))]
    out = quality.principal_components(spark.createDataFrame(rows, "paper_id string, v array<double>"), "v").collect()
    assert out[0]["explained"][0] > 0.95 and abs(np.mean([x["coordinates"][0] for x in out])) < 1e-9


@pytest.mark.parametrize(("value", "state"), [(None, "missing"), ("null", "empty"), ('""', "empty"), ("[]", "empty"), ("{}", "empty"), ("0", "empty"), ("0.0", "empty"), ("false", "empty"), ('"0"', "ok"), ('"false"', "ok"), ("1", "ok"), ("[0]", "ok"), ("true", "ok"), ('" "', "ok")])
def test_missing_and_empty_exclude_each_other(spark, value, state):
    line = '{"other": 1}' if value is None else '{"title": %s}' % value
    assert spark.createDataFrame([(line,)], "value string").select(profile.field_state(F.col("value"), "title")).first()[0] == state


def test_profile_of_nothing_and_of_malformed_lines(spark):
    lines = spark.createDataFrame([("{broken",), ("",), ("[1]",)], "value string")
    assert {tuple(r)[2:] for r in profile.completeness(lines).collect()} == {(0, 0, 0, 0.0, 0, 0.0)}
    assert profile.sample_lines(lines, 2).count() == 2


def test_histogram_keeps_empty_bins(spark):
    rows = profile.length_histogram(spark.createDataFrame([(0,), (127,), (128,), (300,)], "n long"), "n").collect()
    assert [r["n"] for r in rows] == [2, 1, 1, 0, 0, 0, 0, 0] and (rows[-1]["low"], rows[-1]["high"]) == (8192, 300)


@pytest.mark.parametrize(("total", "n", "ratio", "want"), [(10_000, 1_000, 0.8, (200, 800)), (100, 80, 0.9, (30, 50)), (100, 80, 0.1, (50, 30)), (10, 10, 0.5, (5, 5)), (5, 4, 1.0, (1, 3))])
def test_tail_heavy_counts(total, n, ratio, want):
    assert sampling.tail_heavy_counts(total, n, ratio) == want


@pytest.mark.parametrize(("strategy", "share"), [("random", 0.5), ("exponential_decay", 0.85), ("linear_decay", 0.62), ("tail_heavy", 0.8)])
def test_samples_lie_as_their_law_says(spark, strategy, share):
    rows = spark.range(10_000).withColumnRenamed("id", "row_index")
    found = sampling.sample(rows, 1000, strategy)
    assert found.distinct().count() == 1000
    assert abs(found.where("row_index >= 5000").count() / 1000 - share) < 0.06
    assert sum(r["n"] for r in sampling.quartiles(found, 10_000).collect()) == 1000 and sum(r["n"] for r in sampling.density(found, 10_000).collect()) == 1000
    assert sampling.sample(rows, 20_000, strategy, total=10_000).count() == 10_000


def test_merge_checks_and_manifest(spark):
    a = spark.createDataFrame([("x", [1.0, 2.0], 0)], "paper_id string, v array<float>, row_index long")
    b = spark.createDataFrame([("y", [1.0], 0)], "paper_id string, v array<float>, row_index long")
    assert merge.incompatibilities([a, a]) == [] and len(merge.incompatibilities([a, b])) == 1 and len(merge.incompatibilities([a, b.drop("v")])) == 1
    row = merge.manifest([a, b], ["a", "b"], 2).first()
    assert row["merge_info"]["total_rows"] == 2 and [d["filename"] for d in row["file_details"]] == ["a", "b"]


def test_id_diff_can_exceed_all(spark):
    one, two = (spark.createDataFrame([(x,) for x in xs], "paper_id string") for xs in (["a", "a", None], ["a", "b", "c"]))
    row = reconcile.id_diff(one, two).first()
    assert (row["original"], row["embedded"], row["missing"], row["extra"], row["common"], row["success_rate"], row["same"]) == (1, 3, 0, 2, 1, "300.00%", False)
    assert reconcile.id_diff(one.limit(0), two.limit(0)).first()["success_rate"] == "0%"


def test_collection_table(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "point_id long, v string")
    assert collection.create(spark, "points_test", rows, recreate=True) and not collection.create(spark, "points_test", rows)
    collection.upsert(spark, "points_test", rows)
    collection.upsert(spark, "points_test", spark.createDataFrame([(2, "B"), (3, "c")], "point_id long, v string"))
    assert [tuple(r) for r in collection.scroll(spark.table("points_test"), 2, 1).collect()] == [(2, "B"), (3, "c")]
    spark.sql("DROP TABLE points_test")


def test_an_upsert_that_is_broken_off_loses_nothing(spark):
    name, rows = "points_broken", spark.createDataFrame([(1, "a"), (2, "b")], "point_id long, v string")
    collection.create(spark, name, rows, recreate=True, metric="euclidean")
    collection.upsert(spark, name, rows)
    later = spark.createDataFrame([(2, "B")], "point_id long, v string")
    # the next version is there, whole, and the old one is gone
    collection.upserted(spark.table(name), later).write.saveAsTable(f"{name}__next")
    spark.sql(f"DROP TABLE {name}")
    collection.upsert(spark, name, spark.createDataFrame([(3, "c")], "point_id long, v string"))
    assert {tuple(r) for r in spark.table(name).collect()} == {(1, "a"), (2, "B"), (3, "c")}
    # the next version is there beside the old one, or only a part of its files is
    spark.createDataFrame([(9, "half")], "point_id long, v string").write.saveAsTable(f"{name}__next")
    collection.upsert(spark, name, later.limit(0))
    path, _ = collection._table_folder(spark, f"{name}__next")
    spark.createDataFrame([(9, "half")], "point_id long, v string").write.parquet(path.toString())
    collection.upsert(spark, name, later.limit(0))
    assert spark.table(name).count() == 3 and not spark.catalog.tableExists(f"{name}__next")
    assert not collection.create(spark, name, rows) and collection.metric_of(spark, name) in ("euclidean", "cosine")
    spark.sql(f"DROP TABLE {name}")


def test_the_last_row_of_a_key_is_upserted(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "point_id long, v string")
    new = spark.createDataFrame([(2, "x"), (3, "p"), (2, "y"), (3, "q"), (3, None)], "point_id long, v string").coalesce(1)
    assert {tuple(r) for r in collection.upserted(stored, new).collect()} == {(1, "a"), (2, "y"), (3, None)}
    assert {tuple(r) for r in collection.upserted(stored, new.where("v is not null"), order="v").collect()} == {(1, "a"), (2, "y"), (3, "q")}


def test_positions(spark, tmp_path):
    rows = spark.createDataFrame([(f"p{i}", (i * 7919) % 1000 * 1_000_003) for i in range(1000)], "paper_id string, line long")
    placed = stores.with_positions(rows.repartition(7), "line", start=5, width=10_000_000).orderBy("row_index").collect()
    assert [r["row_index"] for r in placed] == list(range(5, 1005)) and [r["line"] for r in placed] == sorted(r["line"] for r in placed)
    path = str(tmp_path / "store")
    assert stores.next_position(spark, path) == 0
    rows.repartition(4).write.parquet(path)
    rows.repartition(3).write.mode("append").parquet(path)
    assert sorted(r["row_index"] for r in stores.read_store(spark, path).collect()) == list(range(2000)) and stores.next_position(spark, path) == 2000
    with pytest.raises(ValueError, match="none of a store"):
        sampling.sample(rows.select(F.monotonically_increasing_id().alias("row_index")).repartition(3).select((F.col("row_index") * 1000 + 1).alias("row_index")), 10, "exponential_decay")
    assert sampling.mean_position(spark.range(11).withColumnRenamed("id", "row_index"), 11).first()["share"] == 0.5
    with pytest.raises(ValueError, match="v: not one vector"):
        merge.assert_equal_lengths(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "v array<double>"))


def test_fetching_files(spark, tmp_path):
    def opener(url):
        if url.endswith("0002.xml.gz"):
            raise OSError("gone")
        return url.encode()

    wanted = stores.download_manifest(spark, 1, 3)
    for _ in range(2):  # what is there isn't fetched again
        done = stores.fetch(wanted, "http://host/base/", str(tmp_path), 2, opener)
        assert stores.fetch_report(done).first().asDict() == {"succeeded": 2, "failed": 1, "bytes": 2 * len("http://host/base/pubmed25n0001.xml.gz")}
    assert {p.name for p in tmp_path.iterdir()} == {"pubmed25n0001.xml.gz", "pubmed25n0003.xml.gz"}


class Answers:
    def __init__(self, *answers):
        self.answers, self.calls = list(answers), 0

    def __call__(self, request, timeout):
        self.calls += 1
        a = self.answers.pop(0)
        if isinstance(a, int):
            raise urllib.error.HTTPError(request.full_url, a, "no", {}, None)
        if isinstance(a, Exception):
            raise a
        return io.BytesIO(json.dumps(a).encode())


def test_requests_are_tried_again():
    good = {"data": [{"embedding": [1.0]}]}
    ok = Answers(429, OSError("down"), good)
    assert embed.HttpEmbedder("http://x/", delay=0, open_url=ok)("t") == [1.0] and ok.calls == 3
    for answers, calls in ((Answers(500, good), 1), (Answers(429, 429, 429, good), 3)):
        with pytest.raises(urllib.error.HTTPError):
            embed.HttpEmbedder("http://x/", delay=0, open_url=answers)("t")
        assert answers.calls == calls
    tei = Answers(500, [[2.0]])
    assert embed.HttpEmbedder("http://x/", api="tei", delay=0, retry_status=True, open_url=tei)("t") == [2.0]


def test_last_token_of_a_transformers_model():
    class Model:
        def __call__(self, **tokens):
            states = np.arange(12.0).reshape(1, 4, 3)
            return type("Out", (), {"last_hidden_state": states})()

    def tokenizer(texts, **more):
        return {"input_ids": np.zeros((1, 4)), "attention_mask": np.array([[1, 1, 1, 0]])}

    found = embed.TransformersEmbedder("m", load=lambda name: (tokenizer, Model()))("text")
    assert np.allclose(found, np.array([6.0, 7.0, 8.0]) / np.linalg.norm([6.0, 7.0, 8.0]))
    assert embed.WordCounter("/no/such/file")("one two  three") == embed.WordCounter()("one two three") == 3


@pytest.fixture
def fussy():
    def make():  # made here, so that workers get it by value
        def embedder(text):
            if "bad" in text:
                raise ValueError("bad text")
            return None if "none" in text else [float(len(text)), 1.0]

        return embedder

    return make


def test_failures_are_rows(spark, fussy):
    papers = spark.createDataFrame([("1", "t", "a"), ("2", "bad", "a"), ("3", "t", "none"), ("4", None, "a")], "id string, title string, abstract string")
    out = embed.embed_papers(papers, fussy, concurrency=3)
    assert {r["paper_id"]: r["error"] for r in embed.failures(out).collect()} == {"2": "ValueError: bad text", "3": "no vector"}
    assert {r["paper_id"] for r in embed.succeeded(out).collect()} == {"1", "4"}
    assert sinks.run_info(out, "m", 2).first()["success_rate"] == "50.00%"
    lengths = embed.token_lengths(papers, "title", lambda: len)
    assert {r["id"]: r["length"] for r in lengths.collect()} == {"1": 1, "2": 3, "3": 1, "4": 0}


def test_stream_stores_each_paper_once(spark, tmp_path, fussy):
    folder, store, failed, check = (str(tmp_path / n) for n in ("in", "store", "failed", "check"))
    (tmp_path / "in").mkdir()

    def put(name, *ids):
        (tmp_path / "in" / name).write_text("".join(json.dumps({"id": i, "title": "bad" if i == "x" else "t", "abstract": "a"}) + "\n" for i in ids) + "{broken\n")

    def run():
        incremental.embed_stream(incremental.paper_stream(spark, folder), store, failed, check, fussy).awaitTermination(120)

    put("one", "a", "b", "a", "x")
    run()
    put("two", "b", "c")
    run()
    assert sorted(r["paper_id"] for r in spark.read.parquet(store).collect()) == ["a", "b", "c"]
    assert [r["paper_id"] for r in spark.read.parquet(failed).collect()] == ["x"]
    assert sorted(r["row_index"] for r in spark.read.parquet(store).collect()) == [0, 1, 2]
    assert [tuple(r) for r in incremental.still_failed(spark, store, failed).collect()] == [("x", "ValueError: bad text")]


def test_agreement_and_texts(spark):
    v = spark.createDataFrame([(1, "a", [1.0, 0.0]), (1, "b", [1.0, 0.0]), (1, "c", [0.0, 1.0])], "text_id int, backend string, v array<float>")
    assert {(r["backend_a"], r["backend_b"]): r["grade"] for r in compare.agreement(v).collect()} == {("a", "b"): "high", ("a", "c"): "different", ("b", "c"): "different"}
    row = spark.createDataFrame([("a\nb", None)], "t string, n string").select(X.one_line(F.col("t")), X.prompted("title", F.col("t")), X.prompted("nope", F.col("t")), X.word_count(F.col("n")), X.percent(F.lit(0), F.lit(0))).first()
    assert tuple(row) == ("a b", "Title: a\nb", "a\nb", 0, "0%")


def test_workbooks(spark, tmp_path, monkeypatch):
    rows = [("f1", f"a{i}", None if i % 3 else 'x <&> "y"\x01\n z') for i in range(40)] + [("f2", "only", "")]
    made = sinks.write_workbooks(spark.createDataFrame(rows, "file string, k string, v string").repartition(5), str(tmp_path))
    assert {tuple(r) for r in made.collect()} == {("f1.xlsx", 40), ("f2.xlsx", 1)}
    for name, want in (("f1", rows[:40]), ("f2", rows[40:])):
        with zipfile.ZipFile(tmp_path / f"{name}.xlsx") as book:
            assert book.testzip() is None and set(book.namelist()) == {*sinks._BOOK, "xl/worksheets/sheet1.xml"}
            for part in book.namelist():
                root = ElementTree.fromstring(book.read(part))
        with zipfile.ZipFile(tmp_path / f"{name}.xlsx") as book:
            root = ElementTree.fromstring(book.read("xl/worksheets/sheet1.xml"))
        space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        cells = [[c.findtext(f"{space}is/{space}t") or "" for c in row] for row in root.iter(f"{space}row")]
        assert cells[0] == ["k", "v"] and sorted(map(tuple, cells[1:])) == sorted((k, (v or "").replace("\x01", "")) for _, k, v in want)
    assert not list(tmp_path.glob("*.part"))


def test_a_sidecar_takes_its_name_when_it_is_whole(spark, tmp_path):
    papers = spark.createDataFrame([("a", "T", 0), ("b", "U", 1)], "id string, title string, row_index long")
    info = spark.createDataFrame([("m",)], "model string")
    for _ in range(2):
        sinks.write_sidecar(sinks.metadata_sidecar(papers, info), str(tmp_path / "meta"))
    assert {p.name for p in tmp_path.iterdir()} == {"meta"} and spark.read.json(str(tmp_path / "meta")).count() == 1
    with pytest.raises(ValueError, match="too many"):
        sinks.metadata_sidecar(papers, info, most=1)


def test_sinks(spark, tmp_path, corpus):
    out = str(tmp_path / "v")
    sinks.append_vectors(corpus, out, rows_per_file=1)
    sinks.append_vectors(corpus, out)
    assert spark.read.parquet(out).count() == 8
    sinks.write_ids(corpus, str(tmp_path / "ids"))
    assert {r[0] for r in spark.read.text(str(tmp_path / "ids" / "txt")).collect()} == {"a", "b", "c", "z"}
    sinks.export_sample(corpus, str(tmp_path / "s"), 2)
    assert spark.read.option("header", True).csv(str(tmp_path / "s" / "csv")).count() == 2
    assert not math.isnan(sinks.sample_rows(corpus, 10).agg(F.sum("similarity")).first()[0])


def test_previews_round_by_the_exact_value(spark):
    """Halves of 8 decimals, doubles next to one, and what is no number, as SQL's format shows them."""
    values = [1 / 512, -3 / 512, 0.123456785, 1 - 1 / 512, 0.999999995, 5e-9, -0.0, 2.0**40 + 1 / 512, 2.0**60, float("nan"), None]
    row = spark.createDataFrame([(values,)], "v array<double>").select(V.preview("v", 11)).first()[0]
    assert row == ["0.00195312", "-0.00585938", "0.12345678", "0.99804688", "1.00000000", "0.00000001", "-0.00000000", "1099511627776.00195312", "1152921504606846976.00000000", "nan", None]
