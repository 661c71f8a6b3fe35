import json

import pytest

from corvane import __main__ as cli


@pytest.fixture
def run(spark):
    def go(*argv):
        a = cli.parser().parse_args([str(x) for x in argv])
        a.run(spark, a)

    return go


def test_from_metadata_to_answers(run, spark, tmp_path, capsys, monkeypatch):
    meta, out = tmp_path / "papers.jsonl", tmp_path / "vectors"
    meta.write_text("".join(json.dumps({"id": str(i), "title": f"title {i}", "abstract": f"about topic {i}"}) + "\n" for i in range(30)) + '{"id": "bad"}\n')
    run("profile", "--input", meta, "--filtered", tmp_path / "clean")
    assert spark.read.text(str(tmp_path / "clean")).count() == 30
    run("lengths", "--input", meta)
    run("embed", "--input", meta, "--out", out, "--limit", 20)
    assert spark.read.parquet(str(out)).count() == 20
    run("failed", "--input", meta, "--vectors", out, "--out", tmp_path / "failed", "--logs", tmp_path / "none.log")
    assert spark.read.json(str(tmp_path / "failed" / "retry")).count() == 10
    run("search", "--vectors", out, "--query", "title 7", "--side", "title", "--metadata", meta, "--out", tmp_path / "hits")
    assert spark.read.json(str(tmp_path / "hits")).count() == 10
    run("search", "--vectors", out, "--paper_id", "3", "--side", "abstract", "--top_k", 1, "--out", tmp_path / "same")
    assert spark.read.json(str(tmp_path / "same")).first()["paper_id"] == "3"
    run("search", "--vectors", out, "--query", "q", "--candidates")
    run("merge", out, out, "--out", tmp_path / "merged")
    assert spark.read.parquet(str(tmp_path / "merged")).count() == 20
    run("stats", "--vectors", out)
    run("sample", "--vectors", out, "--samples", 5, "--strategy", "tail_heavy")
    run("audit", "--vectors", out, "--metadata", meta, "--samples", 5)
    run("import", "--vectors", out, "--metadata", meta, "--collection", "cli_points", "--recreate")
    assert spark.table("cli_points").count() == 20
    spark.sql("DROP TABLE cli_points")
    run("embed", "--input", meta, "--out", out, "--start", 20)  # appended: the places go on
    places = {r["paper_id"]: r["row_index"] for r in spark.read.parquet(str(out)).collect()}
    assert places == {str(i): i for i in range(30)} and len(list(out.glob("*.parquet"))) > 1
    for n, store in enumerate((out, tmp_path / "compact")):  # a rewritten store keeps its places, and so its point ids
        if n:
            spark.read.parquet(str(out)).repartition(1).write.parquet(str(store))
        run("import", "--vectors", store, "--metadata", meta, "--collection", f"cli_{n}", "--recreate", "--metric", "dot")
    assert {tuple(r) for r in spark.table("cli_0").select("point_id", "payload.id").collect()} == {tuple(r) for r in spark.table("cli_1").select("point_id", "payload.id").collect()} == {(i, str(i)) for i in range(30)}
    for n in (0, 1):
        spark.sql(f"DROP TABLE cli_{n}")
    for strategy in ("random", "exponential_decay", "linear_decay", "tail_heavy"):
        run("sample", "--vectors", out, "--samples", 12, "--strategy", strategy, "--out", tmp_path / strategy)
        assert spark.read.json(str(tmp_path / strategy)).count() == 12
    run("lookup", "--vectors", out, "--index", 21, "--out", tmp_path / "at")
    assert spark.read.json(str(tmp_path / "at")).first()["paper_id"] == "21"
    run("compare", out, tmp_path / "compact", "--out", tmp_path / "same")
    assert {r["grade"] for r in spark.read.json(str(tmp_path / "same")).collect()} == {"high"}
    run("lengths", "--input", meta, "--summary", tmp_path / "summary")
    assert "texts: 30" in {r[0] for r in spark.read.text(str(tmp_path / "summary")).collect()}
    questions = iter(["title 7", "about topic 3", ""])
    monkeypatch.setattr("builtins.input", lambda prompt: next(questions))
    run("search", "--vectors", out, "--interactive", "--top_k", 2, "--metadata", meta)
    run("manifest", "--last", 3)
    assert "pubmed25n0003.xml.gz" in capsys.readouterr().out
