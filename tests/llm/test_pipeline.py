"""The pipeline's stages on a small table, each held against a plain rule on its own input."""

import re

import pytest

import corpus_pipeline as pipeline
from corvane.llm.common import DOCUMENT_COLUMNS

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Name -> (rows before, rows after) of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for number, (name, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(number))
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs.collect(), after.collect(), after.columns)
        docs = after
    return out


def test_stages_and_columns(stages):
    assert list(stages) == ["quality classifier", "near duplicates", "benchmark decontamination", "personal data", "best-fit packing"]
    assert all(columns == DOCUMENT_COLUMNS for name, (_, _, columns) in stages.items() if name != "best-fit packing")


def test_quality_keeps_good_documents(stages, spark):
    before, after, _ = stages["quality classifier"]
    kept = {r["doc_id"] for r in after}
    good = [r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r["quality"] == 1]
    assert sum(d in kept for d in good) >= 0.95 * len(good) and set(after) <= set(before)


def test_near_duplicates_leave_one_of_a_group(stages):
    before, after, _ = stages["near duplicates"]

    def shingles(text):
        w = text.lower().split()
        k = min(5, len(w))
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()

    sets = {r["doc_id"]: shingles(r["text"]) for r in before}
    group = {d: d for d in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    assert {r["doc_id"] for r in after} == {d for d in sets if root(d) == d}


def test_benchmark_passages_are_gone(stages, spark):
    before, after, _ = stages["benchmark decontamination"]

    def words(text):
        return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))

    windows = set()
    for item in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(item["text"])
        windows |= {" ".join(w[i : i + 10]) for i in range(max(1, len(w) - 9))}

    def hit(text):
        w = words(text)
        return any(" ".join(w[i : i + 10]) in windows for i in range(len(w)))

    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if not hit(r["text"])}


def test_personal_data_is_replaced(stages):
    before, after, _ = stages["personal data"]
    old = {r["doc_id"]: r for r in before}
    assert len(before) == len(after)
    for r in after:
        assert not re.search(r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\.[A-Za-z]", r["text"]) and r["n_chars"] == len(r["text"])
        assert (r["text"] == old[r["doc_id"]]["text"]) or "[" in r["text"]


def test_packing_takes_every_document(stages):
    before, after, _ = stages["best-fit packing"]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    ends = {}
    for r in sorted(after, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096


def test_run_gives_the_last_stage_s_rows(stages, spark):
    rows = pipeline.run(spark, SF).collect()
    assert {tuple(r)[:5] for r in rows} == {tuple(r)[:5] for r in stages["best-fit packing"][1]}


def test_stages_on_odd_rows(spark, edge_docs, no_docs, tmp_path):
    """Nulls, empty and long texts, repeated rows, rows without an id, and columns with names used inside."""
    for name, given, left in (("odd", edge_docs, {"quality classifier": 9, "near duplicates": 8, "benchmark decontamination": 8, "personal data": 8}), ("none", no_docs, {})):
        docs = given
        for number, (stage, function) in enumerate(pipeline.STAGES):
            path = f"{tmp_path}/{name}{number}"
            labels = SF if name == "none" else f"{tmp_path}/sf"
            if name == "odd" and not number:
                spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{labels}/labels.parquet")
                spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{labels}/benchmark.parquet")
            function(spark, docs, labels).write.parquet(path)
            docs = spark.read.parquet(path)
            if number < 4:
                assert docs.columns == DOCUMENT_COLUMNS and docs.count() == left.get(stage, 0)
        rows = docs.collect()
        assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows) and (len(rows) >= 8) == (name == "odd")


def test_runs_side_by_side_leave_each_other_s_tables(spark):
    first, second = pipeline.run(spark, SF), pipeline.run(spark, SF)
    assert first.count() == second.count() > 0
