"""Schemas of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T

PAPER_FIELDS = ["id", "title", "abstract", "authors", "categories", "journal_ref", "doi", "update_date"]
REQUIRED_FIELDS = ["id", "title", "abstract"]
OPTIONAL_FIELDS = ["authors", "categories", "journal-ref", "doi", "update_date"]

PAPER = T.StructType([T.StructField(f, T.StringType()) for f in PAPER_FIELDS])

#: As papers come in JSON: the hyphenated key, and the parsed author lists of the payload.
RAW_PAPER = T.StructType(
    [T.StructField("journal-ref" if f == "journal_ref" else f, T.StringType()) for f in PAPER_FIELDS] + [T.StructField("authors_parsed", T.ArrayType(T.ArrayType(T.StringType())))]
)

VECTORS = T.StructType(
    [
        T.StructField("paper_id", T.StringType()),
        T.StructField("title_embedding", T.ArrayType(T.FloatType())),
        T.StructField("abstract_embedding", T.ArrayType(T.FloatType())),
        T.StructField("row_index", T.LongType()),
    ]
)

RUN_INFO = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("embedding_dim", T.IntegerType()),
        T.StructField("creation_date", T.StringType()),
        T.StructField("prompt_name", T.StringType()),
        T.StructField("total_papers", T.LongType()),
        T.StructField("failed_papers", T.LongType()),
        T.StructField("success_rate", T.StringType()),
        T.StructField("processing_method", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("compression", T.StringType()),
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("papers_per_second", T.DoubleType()),
    ]
)

#: The 32 output columns of an article, in order, as readers of the flat table expect them.
PUBMED_COLUMNS = [
    "PMID", "pub_date", "Journal_Title", "ArticleTitle", "Authorname", "Initials", "Affiliation", "Language",
    "GrantID", "GrantAgency", "GrantCountry", "PublicationType", "Country", "MedlineTA", "NlmUniqueID", "ISSNLinking",
    "RegistryNumber", "NameOfSubstance", "DescriptorName", "QualifierName", "DescriptorNameMajorTopic", "QualifierNameMajorTopic",
    "Abstract", "OtherAbstract", "Keywords_MajorTopicY", "Keywords_MajorTopicN", "PublicationStatus", "pubmedid", "doi",
    "Citation", "Citatio_pumedid", "Citatio_doi",
]
PUBMED = T.StructType([T.StructField(c, T.StringType()) for c in PUBMED_COLUMNS])
