import gzip
import json

import pytest
from pyspark.sql import functions as F

from corvane.sources import papers as S
from corvane.sources import pubmed, sinks, stores

GOOD = [{"id": str(i), "title": f"t\n{i}", "abstract": f"a {i}", "journal-ref": "j"} for i in range(6)]


@pytest.fixture
def jsonl(tmp_path):
    lines = [json.dumps(GOOD[0]), "", json.dumps(GOOD[1]), "{broken", json.dumps(GOOD[2] | {"title": ""}), json.dumps(GOOD[3]), "[1]", json.dumps(GOOD[4]), json.dumps({"id": "x", "title": "only"})]
    path = tmp_path / "papers.jsonl"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def ids(df):
    return [r["id"] for r in df.orderBy("row_index").collect()]


def test_sniffing(spark, tmp_path, jsonl):
    def made(text):
        path = tmp_path / "f"
        path.write_text(text)
        return str(path)

    assert S.sniff_format(spark, jsonl) == "jsonl"
    assert S.sniff_format(spark, made('{"id": 1}')) == "jsonl"
    assert S.sniff_format(spark, made('[{"id": 1},\n{"id": 2}]')) == "json"
    for text in ("", "\n\n", "no json\nat all"):
        with pytest.raises(ValueError):
            S.sniff_format(spark, made(text))


def test_json_lines(spark, jsonl):
    rows = S.read_papers(spark, jsonl).orderBy("row_index").collect()
    assert [(r["id"], r["title"], r["journal_ref"], r["doi"]) for r in rows] == [("0", "t 0", "j", ""), ("1", "t 1", "j", ""), ("3", "t 3", "j", ""), ("4", "t 4", "j", "")]


def test_start_skips_physical_lines_and_limit_counts_valid_rows(spark, jsonl):
    assert ids(S.read_jsonl(spark, jsonl, start=2)) == ["1", "3", "4"]
    assert ids(S.read_jsonl(spark, jsonl, start=2, limit=2)) == ["1", "3"]
    assert ids(S.read_jsonl(spark, jsonl, limit=0)) == ["0", "1", "3", "4"]


def test_array_window_is_taken_before_validation(spark, tmp_path):
    path = tmp_path / "papers.json"
    path.write_text(json.dumps([GOOD[0], GOOD[1] | {"abstract": ""}, GOOD[2], GOOD[3]], indent=1))
    assert ids(S.read_papers(spark, str(path), limit=3)) == ["0", "2"]
    assert ids(S.read_papers(spark, str(path), start=2, limit=1)) == ["2"]


def test_lines_keep_their_numbers_over_splits(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"line {i}\n" * (i % 7 != 3) or "\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = {r["line"]: r["value"] for r in S.numbered_lines(spark, str(path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == {i: f"line {i}" if i % 7 != 3 else "" for i in range(3000)}


@pytest.mark.parametrize("form", ["list", "papers", "object", "lines"])
def test_metadata_in_every_form_keeps_the_last_of_an_id(spark, tmp_path, form):
    rows = [{"id": "a", "title": "first"}, {"id": "b", "title": "x", "authors_parsed": [["L", "F"]]}, {"title": "no id"}, {"id": "a", "title": "last"}]
    path = tmp_path / "meta"
    path.write_text({"list": json.dumps(rows), "papers": json.dumps({"papers": rows}, indent=1), "object": json.dumps(rows[3], indent=1), "lines": "\n".join(map(json.dumps, rows))}[form])
    found = {r["id"]: r for r in S.load_metadata(spark, str(path)).collect()}
    assert found["a"]["title"] == "last" and set(found) == ({"a"} if form == "object" else {"a", "b"})
    if form != "object":
        assert found["b"]["authors_parsed"] == [["L", "F"]]


def test_sidecar_and_fallback_ids(spark, tmp_path):
    path = tmp_path / "side.json"
    path.write_text(json.dumps({"papers": [{"id": "a"}], "id_to_index": {"a": 0}, "embedding_info": {"model": "m"}}))
    row = S.read_sidecar(spark, str(path)).first()
    assert row["id_to_index"] == {"a": 0} and row["embedding_info"] == {"model": "m"} and len(row["papers"]) == 1
    path = tmp_path / "ids.jsonl"
    path.write_text('{"paper_id": "p", "doi": "d"}\n{"doi": "d2"}\n{"other": 1}\n{"arxiv_id": "x"}\n')
    assert sorted(tuple(r) for r in S.ids_of_metadata(spark, str(path)).collect()) == [("d2", 1), ("p", 0), ("x", 3)]


def test_logs(spark, tmp_path):
    path = tmp_path / "log"
    path.write_text("a - ERROR - 处理论文 12 时出错: x\nb 处理论文 13 的嵌入时出错\n论文 14 处理失败\nERROR 论文ID: 15\n失败 论文 2301.00001\n处理论文 12 时出错\nok\n", encoding="utf-8")
    lines = stores.read_logs(spark, [str(path), str(tmp_path / "missing")])
    assert {r[0] for r in stores.failed_ids(lines).collect()} == {"12", "13", "14", "15", "2301.00001"}
    assert stores.read_logs(spark, [str(tmp_path / "missing")]).count() == 0


ARTICLES = """<?xml version="1.0"?><PubmedArticleSet>
<PubmedArticle><MedlineCitation><PMID Version="1">1</PMID><Article><Journal><JournalIssue><PubDate><Year>2020</Year></PubDate></JournalIssue><Title>J</Title></Journal>
<ArticleTitle>ab <i>c</i> d</ArticleTitle><AuthorList><Author><LastName>L</LastName><Initials>A</Initials></Author><Author><LastName>M</LastName></Author><Author><LastName>N</LastName><Initials>C</Initials></Author></AuthorList>
<Language>eng</Language><Language>ger</Language></Article><MeshHeadingList><MeshHeading><DescriptorName MajorTopicYN="Y">D</DescriptorName><QualifierName MajorTopicYN="N">q</QualifierName><QualifierName MajorTopicYN="Y">r</QualifierName></MeshHeading></MeshHeadingList></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>2</PMID><Article><ArticleTitle><i>x</i> y</ArticleTitle></Article></MedlineCitation><PubmedData><PublicationStatus>epublish</PublicationStatus><ArticleIdList><ArticleId IdType="pubmed">2</ArticleId></ArticleIdList>
<ReferenceList><Reference><Citation>c1</Citation><ArticleIdList><ArticleId IdType="doi">10/r</ArticleId></ArticleIdList></Reference><Reference><Citation>c2</Citation></Reference></ReferenceList></PubmedData></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>3</PMID><broken></MedlineCitation></PubmedArticle>
</PubmedArticleSet>"""


@pytest.mark.parametrize("packed", [False, True])
def test_articles(spark, tmp_path, packed):
    path = tmp_path / ("a.xml.gz" if packed else "a.xml")
    path.write_bytes(gzip.compress(ARTICLES.encode()) if packed else ARTICLES.encode())
    rows = {r["PMID"]: r for r in pubmed.read_articles(spark, str(path)).collect()}
    one, two, bad = rows["1"], rows["2"], rows[""]
    assert (one["ArticleTitle"], one["Initials"], one["Authorname"], one["pub_date"], one["Language"], one["doi"]) == ("ab ", "A//C", "L /M /N ", "2020//", "eng", "")
    assert (one["QualifierName"], one["QualifierNameMajorTopic"], one["DescriptorNameMajorTopic"]) == ("q;r", "r", "D")
    assert (two["ArticleTitle"], two["doi"], two["pubmedid"], two["Citation"], two["Citatio_doi"]) == ("", "10/r", "2", "c1/c2", "10/r/")
    assert bad["error"] and bad["file"] == path.name
    strict = {r["PMID"]: r for r in pubmed.read_articles(spark, str(path), strict_ids=True).collect()}
    assert strict["2"]["doi"] == "" and strict["2"]["pubmedid"] == "2"
    assert tuple(pubmed.file_report(pubmed.read_articles(spark, str(path))).first()) == (path.name, 2, 1)


def test_file_sizes(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    assert stores.file_sizes(scan).count() == 3 and stores.storage_report(scan, 4).first()["rows"] == 100


def test_npz_parts(spark, tmp_path):
    import numpy as np

    for side, moved in (("title", 0), ("abstract", 1)):
        for part in (0, 1):
            ids = np.array([f"p{part}{i + moved * part}" for i in range(3)])
            np.savez(tmp_path / f"{side}_part{part}.npz", ids=ids, embeddings=np.full((3, 2), part + 0.5, np.float16))
    sides = [stores.read_npz(spark, *[str(tmp_path / f"{side}_part{p}.npz") for p in (0, 1)]).withColumn("part", F.regexp_extract("part", "part([0-9])", 1)) for side in ("title", "abstract")]
    rows = stores.zip_parts(*sides).orderBy("pos").collect()
    assert [r["paper_id"] for r in rows] == ["p00", "p01", "p02"] and rows[0]["title_embedding"] == [0.5, 0.5]
    assert [r["part"] for r in stores.mismatched_parts(*sides).collect()] == ["1"]


def test_sidecar_round_trip(spark, tmp_path):
    papers = spark.createDataFrame([("a", "t0", 0), ("b", "t1", 1), ("a", "t2", 2)], "id string, title string, row_index long")
    info = spark.createDataFrame([("m", 4)], "model string, embedding_dim int")
    sinks.write_json(sinks.metadata_sidecar(papers, info), str(tmp_path / "side"))
    row = S.read_sidecar(spark, str(tmp_path / "side")).first()
    assert row["id_to_index"] == {"a": 2, "b": 1} and len(row["papers"]) == 3 and row["embedding_info"]["model"] == "m"


def test_sidecar_in_parts(spark, tmp_path):
    """Several documents of one sidecar, read as one: papers in order, over the files; a second writing replaces the first."""
    papers = spark.range(500).select(F.concat(F.lit('q"{'), F.col("id") % 400).alias("id"), F.concat(F.lit("t,]}\n"), F.col("id")).alias("title"), (499 - F.col("id")).alias("row_index")).repartition(7)
    info = spark.createDataFrame([("m", 4)], "model string, embedding_dim int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for _ in range(2):
            sinks.write_sidecar_parts(papers, info, str(tmp_path / "side"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [json.loads(p.read_text()) for p in (tmp_path / "side").glob("part-*")]
    assert {p.name for p in tmp_path.iterdir()} == {"side"} and sum("papers" in f for f in files) > 1 and all(len(f["papers"]) < 500 for f in files if "papers" in f)
    found, places, settings = S.sidecar_tables(spark, str(tmp_path / "side"))
    want = {r["row_index"]: (r["id"], r["title"]) for r in papers.collect()}
    assert {r["row_index"]: (json.loads(r["value"])["id"], json.loads(r["value"])["title"]) for r in found.collect()} == want
    assert {r["id"]: r["row_index"] for r in places.collect()} == {i: max(n for n, (j, _) in want.items() if j == i) for i, _ in want.values()}
    assert {r["name"]: r["value"] for r in settings.collect()} == {"model": "m", "embedding_dim": "4"}


def test_empty_containers_move_no_paper(spark, tmp_path):
    (tmp_path / "s").mkdir()
    for name, text in (("a", '{"papers": [ ], "id_to_index": {}}'), ("b", '{"papers": [{"id": "x"}, {"id": "y"}]}'), ("c", '{"embedding_info": {}, "papers": [{"id": "z"}]}')):
        (tmp_path / "s" / name).write_text(text)
    found, places, info = S.sidecar_tables(spark, str(tmp_path / "s"))
    assert {r["row_index"]: json.loads(r["value"])["id"] for r in found.collect()} == {0: "x", 1: "y", 2: "z"} and places.isEmpty() and info.isEmpty()


def test_lines_go_on_over_the_files_of_a_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, some in (("p0", GOOD[:2]), ("p1", GOOD[2:3]), ("p2", GOOD[3:])):
        (tmp_path / "in" / name).write_text("".join(json.dumps(o) + "\n" for o in some) + "\n" * (name == "p1"))
    rows = S.read_jsonl(spark, str(tmp_path / "in"), start=1, limit=4).collect()
    assert [(r["row_index"], r["id"]) for r in rows] == [(1, "1"), (2, "2"), (4, "3"), (5, "4")]
    assert {(r["file"][-2:], r["line"]) for r in S.numbered_lines(spark, str(tmp_path / "in")).collect()} >= {("p0", 0), ("p1", 0), ("p2", 0)}
