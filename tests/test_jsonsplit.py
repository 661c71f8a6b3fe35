"""JSON documents that are read in splits, against the whole document."""

import gzip
import json
import random
from contextlib import contextmanager

import pytest

from corvane.sources import jsonsplit as J
from corvane.sources import papers as S


@contextmanager
def splits_of(spark, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def value(r, depth=0):
    text = lambda: "".join(r.choice(['a', ' ', '"', '\\', '{', '}', '[', ']', ',', ':', 'é', '\n', '日']) for _ in range(r.randint(0, 12)))
    kind = r.randint(0, 5 if depth < 3 else 2)
    if kind < 2:
        return text()
    if kind == 2:
        return r.choice([1, -2.5, True, None, ""])
    if kind == 3:
        return [value(r, depth + 1) for _ in range(r.randint(0, 4))]
    return {f"k{i}{text()}": value(r, depth + 1) for i in range(r.randint(0, 4))}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("indent", [None, 1])
def test_elements_of_an_array(spark, tmp_path, seed, indent):
    r = random.Random(seed)
    rows = [value(r) for _ in range(300)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=seed == 1), encoding="utf-8")
    with splits_of(spark, 700):
        document = J.Document(spark, str(tmp_path / "a.json"))
        assert len(document.known) > 10 and any(k[0] for k in document.known.values())  # some splits begin inside a string
        got = {e["index"]: json.loads(e["value"]) for e in document.elements().collect()}
    assert got == dict(enumerate(rows))


def test_an_element_over_many_splits_and_an_empty_array(spark, tmp_path):
    rows = [{"id": 1}, {"id": 2, "parts": [{"x": '}"{' * 50} for _ in range(400)]}, {"id": 3}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text(" [ \n ] \n")
    with splits_of(spark, 2000):
        document = J.Document(spark, str(tmp_path / "a.json"))
        assert len(document.known) > 20
        assert {e["index"]: json.loads(e["value"]) for e in document.elements().collect()} == dict(enumerate(rows))
    assert J.Document(spark, str(tmp_path / "b.json")).elements().count() == 0


def test_containers_of_an_object(spark, tmp_path):
    r = random.Random(9)
    doc = {"first": 1, 'od"d': [value(r) for _ in range(40)], "papers": [{"id": str(i), "t": '"}{'} for i in range(200)], "none": [], "id_to_index": {str(i): i for i in range(200)}}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    with splits_of(spark, 900):
        document = J.Document(spark, str(tmp_path / "d.json"), level=2)
        names = {n["container"]: n["name"] for n in document.names().collect()}
        assert sorted(names.items()) == [(0, 'od"d'), (1, "papers"), (2, "none"), (3, "id_to_index")]
        rows = sorted((e["index"], e["container"], e["value"]) for e in document.elements().collect())
    assert [json.loads(v) for _, c, v in rows if c == 0] == doc['od"d'] and [json.loads(v) for _, c, v in rows if c == 1] == doc["papers"]
    assert json.loads("{" + ",".join(v for _, c, v in rows if c == 3) + "}") == doc["id_to_index"]


def test_papers_metadata_and_sidecars_in_splits(spark, tmp_path):
    rows = [{"id": f"p{i % 90}", "title": f't "{i}" }}', "abstract": "{[" * (i % 50) + "x", "authors_parsed": [["A", "B"]]} for i in range(100)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "s.json").write_text(json.dumps({"embedding_info": {"model": "m", "embedding_dim": "4"}, "papers": rows, "id_to_index": {f"p{i}": i for i in range(90)}}, indent=None))
    with splits_of(spark, 600):
        papers = S.read_papers(spark, str(tmp_path / "a.json"), start=3, limit=50).orderBy("row_index").collect()
        assert [(p["row_index"], p["id"], p["title"]) for p in papers] == [(i, rows[i]["id"], rows[i]["title"]) for i in range(3, 53)]
        for name in ("a.json", "s.json"):
            found = {p["id"]: p["title"] for p in S.load_metadata(spark, str(tmp_path / name)).collect()}
            assert found == {r["id"]: r["title"] for r in rows}
        papers, places, info = S.sidecar_tables(spark, str(tmp_path / "s.json"))
        assert {p["row_index"]: json.loads(p["value"]) for p in papers.collect()} == dict(enumerate(rows))
        assert {tuple(r) for r in places.collect()} == {(f"p{i}", i) for i in range(90)} and {tuple(r) for r in info.collect()} == {("model", "m"), ("embedding_dim", "4")}


def test_several_files_and_compressed_ones(spark, tmp_path):
    for i in range(3):
        with gzip.open(tmp_path / f"{i}.json.gz", "wt") as f:
            json.dump([{"file": i, "n": n} for n in range(20)], f, indent=2)
    got = sorted((json.loads(e["value"])["file"], e["index"]) for e in J.Document(spark, str(tmp_path)).elements().collect())
    assert got == [(i, n) for i in range(3) for n in range(20)]


def test_a_damaged_array_gives_what_can_be_told_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1", "title": "a", "abstract": "b"}, {"id": broken}, {"id": "3", "title": "c", "abstract": "d"}, {"id": "4", "ti')
    assert [r["id"] for r in S.read_json_array(spark, str(tmp_path / "a.json")).orderBy("row_index").collect()] == ["1", "3"]


def test_splits_that_change_are_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i} for i in range(300)]))
    with splits_of(spark, 500):
        known = J.Document(spark, str(tmp_path / "a.json")).known
    with splits_of(spark, 300):
        document = J.Document(spark, str(tmp_path / "a.json"))
        document.known = known
        with pytest.raises(Exception, match="read the document again"):
            document.elements().count()
