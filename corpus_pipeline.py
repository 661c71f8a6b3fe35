"""The corpus pipeline: quality, near duplicates, benchmark passages, personal data, packing.

Each stage takes the documents that its predecessor kept, whole, and returns documents again, with the
columns of ``documents`` (a caller's further columns are left out); the last one returns packed pieces.
``run`` writes each stage's rows to the shared folder and reads them back, so a lost executor never
costs more than the stage at hand.

All stages take nulls in any column, empty and very long texts, repeated rows and empty tables; what
becomes of them is said at each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import decontamination, neardup, packing, pii, quality
from corvane.llm.common import DOCUMENT_COLUMNS, Scratch, table
from corvane.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    A null or empty text is judged by the features of an empty one; a null source or language is a site of
    its own; repeated rows are judged alike; without labels of both kinds all stay.
    """
    return quality.keep_good(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the least id: five-word shingles, similarity 0.8.

    Texts that are null or without words are linked with nothing and stay; of rows with one id, whatever
    their texts, one stays; rows without an id all stay.
    """
    return neardup.keep_one(docs.select(*DOCUMENT_COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go.

    A null or empty text has no window and stays; repeated rows share their fate.
    """
    return decontamination.clean(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows.

    All rows stay; a null text stays null, an empty one empty.
    """
    return pii.redact(docs.select(*DOCUMENT_COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed into sequences of at most 4096 tokens.

    A null or empty text is a piece of the end id alone; repeated rows, and rows without an id, each get
    a place.
    """
    return packing.pack_documents(docs.select("doc_id", "text"), tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("personal data", pii_stage),
    ("best-fit packing", packing_stage),
]

#: The stages learn, sketch, and pack; SQL cannot express them. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that every stage keeps.

    What a stage writes on its way is deleted as soon as its rows are written; the last stage's tables
    stay, as the result reads them.
    """
    docs, scratch, before = table(spark, sf_dir, "documents"), Scratch(spark), None
    for number, (_, stage) in enumerate(STAGES):
        own = Scratch(spark)
        with own.owning():
            docs = stage(spark, docs, sf_dir)
            if number < len(STAGES) - 1:
                docs = scratch.keep(docs)
        if number < len(STAGES) - 1:
            own.clear()
            if before is not None:
                scratch.drop(before)
            before = docs
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
