"""Registered queries of the engine read the documents' texts whole."""

from pyspark.sql import functions as F

from corvane.plans import catalog
from corvane.plans import fixtures as D

SF = "/root/testdata/sf0.001"


def test_valid_papers_return_whole_abstracts(spark):
    docs = D.table(spark, SF, "documents").where("source <> 'src7' AND lang = 'en' AND text <> ''").collect()
    got = {r["id"]: r["abstract"] for r in catalog.queries()["valid_papers"](spark, SF).collect()}
    assert got == {str(d["doc_id"]): d["text"].replace("\n", " ") for d in docs} and max(map(len, got.values())) > 10_000


def test_json_lines_hold_whole_texts(spark):
    held = D.json_lines(spark, SF).join(D.table(spark, SF, "documents").select(F.col("doc_id").alias("row_index"), "text", "source"), "row_index").where("source <> 'src7'")
    assert held.count() > 0 and held.where(F.get_json_object("value", "$.abstract") != F.col("text")).count() == 0
