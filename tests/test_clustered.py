"""Clustered stores: which files are opened and written, and what is left of a writer that was broken off."""

import json

import pytest
from pyspark.sql import functions as F

from corvane.operators import clustered as C


def points(spark, low, high, v="old"):
    return spark.range(low, high).select(F.col("id").alias("point_id"), F.format_string("p%d", "id").alias("paper_id"), F.lit(v).alias("v"))


def made(spark, tmp_path, n=5000, width=100):
    store = C.PaperStore.create(spark, str(tmp_path / "s"), points(spark, 0, 1), width=width, buckets=16, metric="dot")
    store.upsert(points(spark, 0, n))
    return store


def data_files(tmp_path, store="points"):
    return {str(p.relative_to(tmp_path)) for p in (tmp_path / "s" / store).rglob("*.parquet")}


def test_lookups_and_pages_open_few_files(spark, tmp_path):
    store = made(spark, tmp_path)
    assert len(store.points.read().inputFiles()) == 50 and store.points.rows() == 5000 and store.points.properties() == {"metric": "dot"}
    for row, key in ((store.of_point(1234), 1234), (store.of_paper("p4321"), 4321)):
        assert len(row.inputFiles()) == 1 and [tuple(r) for r in row.collect()] == [(key, f"p{key}", "old")]
    page = store.scroll(100, 1249)
    assert len(page.inputFiles()) == 2 and [r["point_id"] for r in page.collect()] == list(range(1250, 1350))
    assert len(store.scroll(10).inputFiles()) == 1 and store.scroll(10, 4999).count() == 0 and [r["point_id"] for r in store.scroll(10, 4995).collect()] == list(range(4996, 5000))
    assert store.of_point(99_999).count() == store.of_point(-1).count() == store.of_paper("nobody").count() == 0


def test_pages_over_gaps_and_negative_keys(spark, tmp_path):
    keys = [-250, -101, -100, -1, 0, 99, 100, 5000, 5001, 2**60]
    store = C.Store.create(spark, str(tmp_path / "s"), points(spark, 0, 1), "point_id", width=100)
    store.upsert(spark.createDataFrame([(k, str(k), "x") for k in keys], "point_id long, paper_id string, v string"))
    for after in (None, *keys, 7):
        for n in (1, 3, 20):
            assert [r["point_id"] for r in store.scroll(n, after).collect()] == [k for k in keys if after is None or k > after][:n]
    assert all(store.lookup(k).count() == 1 for k in keys)


def test_an_upsert_writes_the_buckets_it_touches(spark, tmp_path):
    store = made(spark, tmp_path)
    before = data_files(tmp_path)
    assert store.upsert(points(spark, 2050, 2550, "new")) == [20, 21, 22, 23, 24, 25]
    live = {f.split("/s/")[1] for f in store.points.read().inputFiles()}
    assert len(live - {f[2:] for f in before}) == 6 and len(live) == 50 and before < data_files(tmp_path)
    got = {r["point_id"]: r["v"] for r in store.points.read().collect()}
    assert got == {i: "new" if 2050 <= i < 2550 else "old" for i in range(5000)}
    twice = points(spark, 7, 8, "first").unionByName(points(spark, 7, 8, "second"))
    store.upsert(twice.withColumn("o", F.when(F.col("v") == "first", 2).otherwise(1)), order="o")
    assert store.of_point(7).first()["v"] == "first" and store.points.rows() == 5000
    store.points.vacuum()
    store.index.vacuum()
    assert len(data_files(tmp_path)) == 50 and store.points.read().count() == 5000


def test_a_paper_that_moves_is_found_at_its_new_point_only(spark, tmp_path):
    store = made(spark, tmp_path, 300)
    store.upsert(spark.createDataFrame([(5, "other", "x"), (777, "p5", "x")], "point_id long, paper_id string, v string"))
    assert store.of_paper("p5").first()["point_id"] == 777 and store.of_paper("other").first()["point_id"] == 5
    store.upsert(spark.createDataFrame([(777, "again", "x")], "point_id long, paper_id string, v string"))
    assert store.of_paper("p5").count() == 0


@pytest.mark.parametrize("step", ["new", "all", "claim", "rename"])
def test_broken_off_anywhere_the_old_version_is_whole(spark, tmp_path, monkeypatch, step):
    store = C.Store.create(spark, str(tmp_path / "s"), points(spark, 0, 1), "point_id", width=100)
    store.upsert(points(spark, 0, 500))
    later, write, put = points(spark, 90, 110, "new"), C.Store._write, C.Store._put

    def broken_write(self, rows, key, version, to):
        write(self, rows, key, version, to)
        if to.endswith(step):
            raise KeyboardInterrupt

    def broken_put(self, number, version):
        if step == "rename":  # the number was claimed, and no more
            self.fs.create(self.hadoop.Path(f"{self.path}/versions/.claim-{number:012d}"), False).close()
        raise KeyboardInterrupt

    monkeypatch.setattr(C.Store, "_write", broken_write)
    if step in ("claim", "rename"):
        monkeypatch.setattr(C.Store, "_put", broken_put)
    with pytest.raises(KeyboardInterrupt):
        store.upsert(later)
    assert {r["v"] for r in store.read().collect()} == {"old"} and store.read().count() == store.rows() == 500
    monkeypatch.setattr(C.Store, "_write", write)
    monkeypatch.setattr(C.Store, "_put", put)
    if step == "rename":
        with pytest.raises(C.Conflict):
            store.upsert(later)
        assert store.read().where("v = 'new'").count() == 0
        monkeypatch.setattr(C, "STALE", -10)
    assert store.upsert(later) == [0, 1] and store.read().where("v = 'new'").count() == 20 and store.read().count() == 500


def test_of_two_writers_the_slower_changes_nothing(spark, tmp_path, monkeypatch):
    store = C.Store.create(spark, str(tmp_path / "s"), points(spark, 0, 1), "point_id", width=100)
    store.upsert(points(spark, 0, 300))
    put = C.Store._put

    def late(self, number, version):
        monkeypatch.setattr(C.Store, "_put", put)
        C.Store(spark, self.path).upsert(points(spark, 0, 5, "faster"))
        return put(self, number, version)

    monkeypatch.setattr(C.Store, "_put", late)
    with pytest.raises(C.Conflict):
        store.upsert(points(spark, 0, 10, "slower"))
    assert {r["v"]: r["n"] for r in store.read().groupBy("v").agg(F.count("*").alias("n")).collect()} == {"old": 295, "faster": 5}


def test_faults_and_nothing(spark, tmp_path):
    store = C.Store.create(spark, str(tmp_path / "s"), points(spark, 0, 1), "paper_id", buckets=4)
    assert store.read().count() == 0 and store.upsert(points(spark, 0, 0)) == [] and store.read().count() == 0
    with pytest.raises(ValueError, match="without paper_id"):
        store.upsert(points(spark, 0, 9).withColumn("paper_id", F.when(F.col("point_id") != 4, F.col("paper_id"))))
    assert store.read().count() == 0
    store.upsert(points(spark, 0, 9))
    assert store.lookup("p3").count() == 1
    for wrong in (lambda: store.scroll(3), lambda: C.Store.create(spark, str(tmp_path / "t"), points(spark, 0, 1), "point_id")):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(FileExistsError):
        C.Store.create(spark, str(tmp_path / "s"), points(spark, 0, 1), "point_id", width=5)
    with pytest.raises(FileNotFoundError):
        C.Store(spark, str(tmp_path / "none")).read()


def test_command_line(spark, tmp_path):
    from corvane.__main__ import main

    spark.createDataFrame([(f"p{i}", i, [1.0], [2.0]) for i in range(20)], "paper_id string, row_index long, title_embedding array<float>, abstract_embedding array<float>").write.parquet(str(tmp_path / "v"))
    (tmp_path / "m.jsonl").write_text("".join(json.dumps({"id": f"p{i}", "title": f"T{i}"}) + "\n" for i in range(20)))
    for _ in range(2):
        main(["import", "--vectors", str(tmp_path / "v"), "--metadata", str(tmp_path / "m.jsonl"), "--store", str(tmp_path / "s")])
    main(["lookup", "--store", str(tmp_path / "s"), "--paper_id", "p7", "--out", str(tmp_path / "o")])
    row = spark.read.json(str(tmp_path / "o")).first()
    assert (row["point_id"], row["payload"]["title"], row["title_dim"]) == (7, "T7", 1)
