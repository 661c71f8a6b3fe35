"""PubMed articles from XML (plain or gzipped) to 32 text columns.

Files are read as text records that end at an article's closing tag, so plain files split and no
file is held whole. Each record is parsed by itself: a damaged article becomes a failure row, not a
lost file. Text is what stands before an element's first child. Lists keep empty members, so that
parallel lists stay aligned; ``/`` joins elements, ``;`` joins what belongs to one element.
"""

from __future__ import annotations

import re
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PUBMED_COLUMNS

CLOSING = "</PubmedArticle>"
_START = re.compile(r"<PubmedArticle[\s>]")


def _text(node, path: str) -> str:
    found = node.find(path) if node is not None else None
    return (found.text or "") if found is not None else ""


def _texts(node, path: str, mark: str = "/") -> str:
    return mark.join(n.text or "" for n in node.findall(path)) if node is not None else ""


def _rows(node, path: str) -> list:
    return node.findall(path) if node is not None else []


def _at(node, path: str):
    return node.find(path) if node is not None else None


def article_columns(article: ElementTree.Element, strict_ids: bool = False) -> dict[str, str]:
    """The 32 columns of one article. ``strict_ids`` takes the article's own ids only, not those of
    its references where it has none."""
    citation, data = _at(article, "MedlineCitation"), _at(article, "PubmedData")
    body = _at(citation, "Article")
    journal, info, mesh = _at(body, "Journal"), _at(citation, "MedlineJournalInfo"), _at(citation, "MeshHeadingList")
    date = _at(journal, "JournalIssue/PubDate")
    authors, grants = _rows(body, "AuthorList/Author"), _rows(body, "GrantList/Grant")
    chemicals, headings = _rows(citation, "ChemicalList/Chemical"), _rows(mesh, "MeshHeading")
    references = _rows(data, ".//Reference")
    other = _at(citation, ".//OtherAbstract")
    keywords = citation if _at(citation, "KeywordList") is not None else None
    own = "ArticleIdList/" if strict_ids else ".//"

    def each(rows, path):
        return "/".join(_text(r, path) for r in rows)

    return {
        "PMID": _text(citation, "PMID"),
        "pub_date": "/".join(_text(date, p) for p in ("Year", "Month", "Day")),
        "Journal_Title": _text(journal, "Title"),
        "ArticleTitle": _text(body, "ArticleTitle"),
        "Authorname": "/".join(f"{_text(a, './/LastName')} {_text(a, './/ForeName')}" for a in authors),
        "Initials": each(authors, ".//Initials"),
        "Affiliation": "/".join(_texts(a, ".//Affiliation", ";") for a in authors),
        "Language": _text(body, "Language"),
        "GrantID": each(grants, "GrantID"),
        "GrantAgency": each(grants, "Agency"),
        "GrantCountry": each(grants, "Country"),
        "PublicationType": _texts(_at(body, "PublicationTypeList"), "PublicationType"),
        "Country": _text(info, "Country"),
        "MedlineTA": _text(info, "MedlineTA"),
        "NlmUniqueID": _text(info, "NlmUniqueID"),
        "ISSNLinking": _text(info, "ISSNLinking"),
        "RegistryNumber": each(chemicals, "RegistryNumber"),
        "NameOfSubstance": each(chemicals, "NameOfSubstance"),
        "DescriptorName": each(headings, "DescriptorName"),
        "QualifierName": "/".join(_texts(h, "QualifierName", ";") for h in headings),
        "DescriptorNameMajorTopic": _texts(mesh, ".//DescriptorName[@MajorTopicYN='Y']"),
        "QualifierNameMajorTopic": _texts(mesh, ".//QualifierName[@MajorTopicYN='Y']"),
        "Abstract": _texts(_at(body, "Abstract"), "AbstractText"),
        "OtherAbstract": _texts(other, ".//AbstractText"),
        "Keywords_MajorTopicY": _texts(keywords, ".//Keyword[@MajorTopicYN='Y']"),
        "Keywords_MajorTopicN": _texts(keywords, ".//Keyword[@MajorTopicYN='N']"),
        "PublicationStatus": _text(data, "PublicationStatus"),
        "pubmedid": _text(data, f"{own}ArticleId[@IdType='pubmed']"),
        "doi": _text(data, f"{own}ArticleId[@IdType='doi']"),
        "Citation": each(references, "Citation"),
        "Citatio_pumedid": each(references, ".//ArticleId[@IdType='pubmed']"),
        "Citatio_doi": each(references, ".//ArticleId[@IdType='doi']"),
    }


SHREDDED = T.StructType([T.StructField("file", T.StringType()), *[T.StructField(c, T.StringType()) for c in PUBMED_COLUMNS], T.StructField("error", T.StringType())])


def shred(records: DataFrame, strict_ids: bool = False) -> DataFrame:
    """file, the 32 columns, error of records (file, value: one article's XML, other text around it allowed).

    Records without an article (such as a file's last lines) give no row; a record that cannot be
    parsed gives one with empty columns and the error.
    """

    def work(frames):
        for frame in frames:
            out = []
            for file, value in zip(frame.column("file").to_pylist(), frame.column("value").to_pylist()):
                start = _START.search(value or "")
                if not start:
                    continue
                text = value[start.start() :]
                row = dict.fromkeys(PUBMED_COLUMNS, "") | {"file": file, "error": None}
                try:
                    row |= article_columns(ElementTree.fromstring(text if CLOSING in text else text + CLOSING), strict_ids)
                except ElementTree.ParseError as e:
                    row["error"] = str(e)
                out.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], pa.string()) for n in SHREDDED.names], names=SHREDDED.names)

    return records.select("file", "value").mapInArrow(work, SHREDDED)


def read_articles(spark: SparkSession, path: str, strict_ids: bool = False) -> DataFrame:
    records = spark.read.option("lineSep", CLOSING).text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    return shred(records, strict_ids)


def file_report(shredded: DataFrame) -> DataFrame:
    """file, ok, failed: articles of each file."""
    return shredded.groupBy("file").agg(F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("failed"))
