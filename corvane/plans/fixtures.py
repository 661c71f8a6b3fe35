"""The engine's input tables as views of the standard test tables, in Spark and in SQL."""

from __future__ import annotations

import atexit
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources.hdf5 import as_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as papers: the first line is the title, the language the category."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.col("text").alias("abstract"), F.lit("").alias("authors"),
        F.col("lang").alias("categories"), F.col("source").alias("journal_ref"), F.lit("").alias("doi"), F.lit("").alias("update_date"), F.col("doc_id").alias("row_index"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as title vectors; the abstract vector is the next row's, the last row's the first."""
    e = table(spark, sf_dir, "embeddings")
    total = e.agg(F.count(F.lit(1)).alias("n"))
    following = e.select(F.col("vec_id").alias("next_id"), F.col("embedding").alias("abstract_embedding"))
    numbered = e.crossJoin(F.broadcast(total)).withColumn("next_id", F.pmod(F.col("vec_id") + 1, F.col("n")))  # one row
    return numbered.join(following, "next_id").select(F.col("vec_id").cast("string").alias("paper_id"), F.col("embedding").alias("title_embedding"), "abstract_embedding", F.col("vec_id").alias("row_index"), "label")


def query_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").where("vec_id = 0").select(F.col("embedding").alias("q"))


def shards(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two vector tables that share half of their ids."""
    e = table(spark, sf_dir, "embeddings")
    first = e.select(F.col("vec_id").cast("string").alias("paper_id"), "embedding", F.col("vec_id").alias("row_index"))
    second = e.select((F.col("vec_id") * 2).cast("string").alias("paper_id"), "embedding", F.col("vec_id").alias("row_index"))
    return [first, second]


def source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("paper_id"))


def stored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents stand for those that a store has."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("paper_id"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line an event: failures of both wordings, and other lines."""
    failed = F.concat(F.lit("t - ERROR - 处理论文 "), F.col("event_id").cast("string"), F.when(F.col("value") < 50, " 的嵌入时出错: b").otherwise(" 时出错: b"))
    return table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", failed).otherwise(F.concat(F.lit("t - INFO - ok "), F.col("event_id").cast("string"))).alias("value"))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers as JSON lines with defects by language: French lacks the title, German has an empty one,
    Spanish a null one; one source's lines are cut off."""
    p = papers(spark, sf_dir)
    rest = ["id", "abstract", "categories", F.lit("").alias("doi")]
    plain = {"ignoreNullFields": "false"}
    line = (
        F.when(F.col("categories") == "fr", F.to_json(F.struct(*rest)))
        .when(F.col("categories") == "de", F.to_json(F.struct(F.lit("").alias("title"), *rest)))
        .when(F.col("categories") == "es", F.to_json(F.struct(F.lit(None).cast("string").alias("title"), *rest), plain))
        .otherwise(F.to_json(F.struct(F.lit("a title").alias("title"), *rest)))
    )
    return p.select("id", "row_index", F.when(F.col("journal_ref") == "src7", F.left(line, F.lit(12))).otherwise(line).alias("value"))


def folder(spark: SparkSession) -> str:
    """A new folder in the shared one, for files that a query reads back; it goes when the driver's Python ends."""
    path = f"{shared_folder(spark)}/corvane-files-{uuid.uuid4().hex}"

    def remove() -> None:
        with suppress(Exception):  # the session may be gone
            there = spark._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)

    atexit.register(remove)
    return path


def whole_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lines of ``json_lines`` that aren't cut off."""
    return json_lines(spark, sf_dir).join(table(spark, sf_dir, "documents").where("source = 'src7'").select(F.col("doc_id").alias("row_index")), "row_index", "left_anti")


def write_arrays(lines: DataFrame, path: str) -> None:
    """JSON lines (value) as array documents, one a partition."""

    def work(frames):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array(["["])], names=["value"])
        first = True
        for frame in frames:
            values = frame.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([v if first and i == 0 else f",{v}" for i, v in enumerate(values)], pa.string())], names=["value"])
            first = first and not values
        yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])

    lines.select("value").mapInArrow(work, "value string").write.text(path)


def write_npz(vectors: DataFrame, path: str) -> None:
    """Ids and vectors (two columns) as NPZ parts, one a partition, compressed for every other one."""
    folder = as_path(path)

    def work(frames):
        import os

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        number, ids, found = TaskContext.get().partitionId(), [], []
        for frame in frames:
            ids += frame.column(0).to_pylist()
            found += frame.column(1).to_pylist()
        os.makedirs(folder, exist_ok=True)
        part = f"{folder}/.part{number}.{os.getpid()}.npz"
        (np.savez_compressed if number % 2 else np.savez)(part, ids=np.array(ids), embeddings=np.array(found, np.float32))
        os.replace(part, f"{folder}/part{number}.npz")
        yield pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int64())], names=["n"])

    vectors.mapInArrow(work, "n bigint").count()


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, value: each document as an article's XML in which every element that is read stands, most of them twice."""
    d = table(spark, sf_dir, "documents")
    number, lang, source = F.col("doc_id").cast("string"), F.col("lang"), F.col("source")
    text = F.col("text")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        text = F.replace(text, F.lit(a), F.lit(b))

    def e(name: str, *inside, **attributes) -> F.Column:
        marks = "".join(f' {k}="{v}"' for k, v in attributes.items())
        return F.concat(F.lit(f"<{name}{marks}>"), *[F.lit(x) if isinstance(x, str) else x for x in inside], F.lit(f"</{name}>"))

    journal = e("Journal", e("JournalIssue", e("PubDate", e("Year", "2024"), e("Month", "Mar"), e("Day", lang))), e("Title", "Journal of ", source))
    authors = e("AuthorList", e("Author", e("LastName", source), e("ForeName", lang), e("Initials", "I"), e("AffiliationInfo", e("Affiliation", source)), e("AffiliationInfo", e("Affiliation", lang))), e("Author", e("LastName", lang), e("Initials", lang)))
    grants = e("GrantList", e("Grant", e("GrantID", "G", number), e("Agency", source), e("Country", lang)), e("Grant", e("Agency", "none")))
    types = e("PublicationTypeList", e("PublicationType", "Article"), e("PublicationType", lang))
    body = e("Article", journal, e("ArticleTitle", F.split_part(text, F.lit("\n"), F.lit(1)), "<i>more</i> text"), e("Abstract", e("AbstractText", text), "<AbstractText/>", e("AbstractText", source)), authors, e("Language", lang), grants, types)
    info = e("MedlineJournalInfo", e("Country", lang), e("MedlineTA", "J ", source), e("NlmUniqueID", "N", number), e("ISSNLinking", "1234-", number))
    chemicals = e("ChemicalList", e("Chemical", e("RegistryNumber", "R", number), e("NameOfSubstance", source)), e("Chemical", e("RegistryNumber", "0"), e("NameOfSubstance", lang)))
    mesh = e("MeshHeadingList", e("MeshHeading", e("DescriptorName", lang, MajorTopicYN="Y"), e("QualifierName", "q1", MajorTopicYN="Y"), e("QualifierName", "q2", MajorTopicYN="N")), e("MeshHeading", e("DescriptorName", source, MajorTopicYN="N")))
    other = e("OtherAbstract", e("AbstractText", "other ", lang), e("AbstractText", source))
    words = e("KeywordList", e("Keyword", lang, MajorTopicYN="Y"), e("Keyword", "z", MajorTopicYN="N"), e("Keyword", source, MajorTopicYN="Y"))
    references = e("ReferenceList", e("Reference", e("Citation", "cites ", number), e("ArticleIdList", e("ArticleId", "P", number, IdType="pubmed"), e("ArticleId", "D", number, IdType="doi"))), e("Reference", e("Citation", source)))
    data = e("PubmedData", e("PublicationStatus", "ppublish"), e("ArticleIdList", e("ArticleId", number, IdType="pubmed"), e("ArticleId", "10/", number, IdType="doi")), references)
    return d.select(F.lit("f").alias("file"), e("PubmedArticle", e("MedlineCitation", e("PMID", number), body, info, chemicals, mesh, other, words), data).alias("value"))


# The columns of ``articles``, as SQL over documents.
ARTICLE_SQL = {
    "PMID": "CAST(doc_id AS VARCHAR)", "pub_date": "'2024/Mar/' || lang", "Journal_Title": "'Journal of ' || source", "ArticleTitle": "split_part(text, chr(10), 1)", "Authorname": "source || ' ' || lang || '/' || lang || ' '", "Initials": "'I/' || lang", "Affiliation": "source || ';' || lang || '/'",
    "Language": "lang", "GrantID": "'G' || doc_id || '/'", "GrantAgency": "source || '/none'", "GrantCountry": "lang || '/'", "PublicationType": "'Article/' || lang", "Country": "lang", "MedlineTA": "'J ' || source", "NlmUniqueID": "'N' || doc_id", "ISSNLinking": "'1234-' || doc_id",
    "RegistryNumber": "'R' || doc_id || '/0'", "NameOfSubstance": "source || '/' || lang", "DescriptorName": "lang || '/' || source", "QualifierName": "'q1;q2/'", "DescriptorNameMajorTopic": "lang", "QualifierNameMajorTopic": "'q1'", "Abstract": "text || '//' || source", "OtherAbstract": "'other ' || lang || '/' || source",
    "Keywords_MajorTopicY": "lang || '/' || source", "Keywords_MajorTopicN": "'z'", "PublicationStatus": "'ppublish'", "pubmedid": "CAST(doc_id AS VARCHAR)", "doi": "'10/' || doc_id", "Citation": "'cites ' || doc_id || '/' || source", "Citatio_pumedid": "'P' || doc_id || '/'", "Citatio_doi": "'D' || doc_id || '/'",
}

CORPUS_SQL = """pv AS (SELECT CAST(a.vec_id AS VARCHAR) AS paper_id, a.vec_id AS row_index, a.label, CAST(a.embedding AS DOUBLE[]) AS t, CAST(b.embedding AS DOUBLE[]) AS ab
 FROM embeddings a CROSS JOIN (SELECT count(*) AS n FROM embeddings) m JOIN embeddings b ON b.vec_id = (a.vec_id + 1) % m.n)"""
QUERY_SQL = "qv AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0)"
PAPERS_SQL = "papers AS (SELECT CAST(doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title, text AS abstract, lang AS categories, source AS journal_ref, doc_id AS row_index FROM documents)"
SHARDS_SQL = "shards AS (SELECT 0 AS shard, CAST(vec_id AS VARCHAR) AS paper_id, vec_id AS row_index FROM embeddings UNION ALL SELECT 1, CAST(vec_id * 2 AS VARCHAR), vec_id FROM embeddings)"
