"""Paper metadata from JSON lines, JSON arrays and sidecar documents, as typed frames.

Rows carry ``_present``, the keys that were in the object: a missing key and a null value differ.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import one_line
from ..schemas import PAPER_FIELDS, RAW_PAPER
from .jsonsplit import Document, top_level

ID_FIELDS = ["id", "paper_id", "arxiv_id", "doi"]


def sniff_format(spark: SparkSession, path: str) -> str:
    """``jsonl`` or ``json`` from the first lines of a file; ValueError if it is empty or neither. An array is told by its first bytes."""
    if top_level(spark, path) == "[":
        return "json"
    head = [r["value"] for r in spark.read.text(path).limit(2).collect()]

    def parses(text: str) -> bool:
        try:
            json.loads(text)
            return True
        except ValueError:
            return False

    if not head or not head[0].strip():
        raise ValueError(f"{path} is empty")
    first = head[0].strip()
    if parses(first) and (len(head) == 1 or not head[1].strip() or parses(head[1])):
        return "jsonl"
    if first.startswith("{"):  # an object over several lines
        return "json"
    raise ValueError(f"{path} is neither JSON lines nor a JSON array")


def numbered_lines(spark: SparkSession, paths: str | Sequence[str], together: bool = False) -> DataFrame:
    """file, line (from 0, blank lines counted), value of text files; ``together`` counts on over the files, in order of their names.

    Files are split and read in parallel. A line's number is its place in its split and the number of
    lines in the splits before; only these counts, a row a split, are shuffled.
    """
    raw = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place"))
    splits = raw.groupBy("file", "start").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("lines"))
    order = Window.orderBy("file", "start") if together else Window.partitionBy("file").orderBy("start")  # a row a split
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    moved = splits.select(F.col("file").alias("f"), F.col("start").alias("s"), "first", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("base"))
    return raw.join(F.broadcast(moved), (F.col("file") == F.col("f")) & (F.col("start") == F.col("s"))).select("file", (F.col("place") - F.col("first") + F.col("base")).cast("long").alias("line"), "value")


def parsed(lines: DataFrame, value: str = "value") -> DataFrame:
    """Objects of a JSON column: the other columns, ``paper`` (RAW_PAPER), ``_present`` and ``_raw``.

    Blank lines, malformed lines and values that are no objects are dropped.
    """
    text = F.col(value)
    others = [c for c in lines.columns if c != value]
    good = lines.where(F.try_parse_json(text).isNotNull() & F.trim(text).startswith("{"))
    return good.select(*others, F.from_json(text, RAW_PAPER).alias("paper"), F.json_object_keys(text).alias("_present"), text.alias("_raw"))


def read_jsonl(spark: SparkSession, path: str, start: int = 0, limit: int | None = None) -> DataFrame:
    """Valid papers of JSON lines: ``start`` skips physical lines, ``limit`` counts valid papers (0: no limit).

    The files of a folder are parts of one list, in order of their names.
    """
    lines = numbered_lines(spark, path, together=True).where(F.col("line") >= start)
    found = valid(parsed(lines.select(F.col("line").alias("row_index"), "value")))
    return found.orderBy("row_index").limit(limit) if limit else found


def read_json_array(spark: SparkSession, path: str, start: int = 0, limit: int | None = None) -> DataFrame:
    """Valid papers of a JSON array: the window of elements is taken first, so fewer rows may come out.

    The array is read in splits, however its lines end; see ``jsonsplit``.
    """
    elements = Document(spark, path).elements().select(F.col("index").alias("row_index"), "value")
    window = F.col("row_index") >= start
    if limit:
        window = window & (F.col("row_index") < start + limit)
    return valid(parsed(elements.where(window)))


def read_papers(spark: SparkSession, path: str, start: int = 0, limit: int | None = None) -> DataFrame:
    return (read_jsonl if sniff_format(spark, path) == "jsonl" else read_json_array)(spark, path, start, limit)


def valid_ids(spark: SparkSession, path: str, start: int = 0, limit: int | None = None) -> DataFrame:
    """paper_id of the papers that an embedding run would take, as ``read_papers``; empty ids are left out."""
    return read_papers(spark, path, start, limit).select(F.col("id").alias("paper_id")).where("paper_id <> ''")


def field(name: str) -> Column:
    """A field of ``paper``: empty if the key is absent, null if its value is."""
    key = "journal-ref" if name == "journal_ref" else name
    return F.when(F.array_contains("_present", key), F.col(f"paper.`{key}`")).otherwise(F.lit(""))


def normalised(rows: DataFrame) -> DataFrame:
    """Parsed rows as the eight paper fields, line feeds in title and abstract replaced."""
    others = [c for c in rows.columns if c not in ("paper", "_present", "_raw")]
    columns = [(one_line(field(f)) if f in ("title", "abstract") else field(f)).alias(f) for f in PAPER_FIELDS]
    return rows.select(*others, *columns)


def valid(rows: DataFrame) -> DataFrame:
    """Normalised rows whose title and abstract are not empty."""
    return normalised(rows).where("title <> '' and abstract <> ''")


def load_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Papers by id from JSON lines, a list, ``{papers: [...]}`` or one object; the last of an id wins."""
    if sniff_format(spark, path) == "jsonl" and spark.read.text(path).where(F.trim("value") != "").limit(2).count() == 2:
        lines = numbered_lines(spark, path).select("line", "value")
    elif top_level(spark, path) == "[":
        lines = Document(spark, path).elements().select(F.col("index").alias("line"), "value")
    else:
        document = Document(spark, path, level=2)
        papers = document.names().where("name = 'papers'").select("file", "container")
        if papers.isEmpty():  # one paper
            lines = spark.read.text(path, wholetext=True).select(F.lit(0).cast("long").alias("line"), "value")
        else:
            lines = document.elements().join(papers, ["file", "container"], "left_semi").select(F.col("index").alias("line"), "value")
    found = parsed(lines).where(F.array_contains("_present", "id"))
    rows = normalised(found.withColumn("authors_parsed", F.coalesce("paper.authors_parsed", F.array().cast("array<array<string>>"))))
    return last_of_id(rows, "line")


def last_of_id(rows: DataFrame, order: str) -> DataFrame:
    """One row an id, the one with the largest ``order``."""
    others = [c for c in rows.columns if c not in ("id", order)]
    return rows.groupBy("id").agg(F.max_by(F.struct(*others), order).alias("r")).select("id", "r.*")


def ids_of_metadata(spark: SparkSession, path: str) -> DataFrame:
    """paper_id, line of JSON lines whose id stands in the first of ID_FIELDS that is there."""
    rows = parsed(numbered_lines(spark, path).select("line", "value"))
    chosen = F.lit(None).cast("string")
    for name in reversed(ID_FIELDS):
        chosen = F.when(F.array_contains("_present", name), F.get_json_object("_raw", f"$.{name}")).otherwise(chosen)
    return rows.select(chosen.alias("paper_id"), "line").where("paper_id <> ''")


def sidecar_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """papers (row_index, value: raw JSON), id_to_index (id, row_index), embedding_info (name, value) of a metadata sidecar.

    The document is read in splits, so neither list is ever one value. A container that is missing gives no rows.
    A folder of documents (``sinks.write_sidecar_parts``) is read as one, whose papers go on in order of the files'
    names. Of each container its name and place, and no element, go through the driver: three rows a document.
    """
    document = Document(spark, path, level=2)
    spans = sorted(document.spans().where(F.col("name").isin("papers", "id_to_index", "embedding_info")).collect())

    def own(name: str) -> DataFrame:
        moved, n = [], 0
        for span in spans:
            if span["name"] == name:
                moved.append((span["file"], span["container"], n - span["first"]))
                n += 0 if span["last"] is None else span["last"] - span["first"] + 1
        places = spark.createDataFrame(moved, "file string, container bigint, moved bigint")
        return document.elements({file for file, _, _ in moved}).join(F.broadcast(places), ["file", "container"])  # a row a document

    one = lambda kind: F.map_entries(F.from_json(F.concat(F.lit("{"), "value", F.lit("}")), f"map<string,{kind}>"))[0]
    pairs = lambda name, kind, *names: own(name).select(one(kind).alias("e")).select(F.col("e.key").alias(names[0]), F.col("e.value").alias(names[1]))
    return own("papers").select((F.col("index") + F.col("moved")).alias("row_index"), "value"), pairs("id_to_index", "bigint", "id", "row_index"), pairs("embedding_info", "string", "name", "value")


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """One row: papers (raw JSON), id_to_index, embedding_info, as ``sinks.metadata_sidecar`` makes it; for small runs, else ``sidecar_tables``."""
    papers, places, info = sidecar_tables(spark, path)
    listed = papers.agg(F.transform(F.array_sort(F.collect_list(F.struct("row_index", "value"))), lambda p: p["value"]).alias("papers"))
    one = places.agg(F.map_from_entries(F.collect_list(F.struct("id", "row_index"))).alias("id_to_index"))
    held = info.agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("embedding_info"))
    return listed.crossJoin(one).crossJoin(held)  # one row each


def papers_with_ids(papers: DataFrame, ids: DataFrame) -> DataFrame:
    """Papers whose id is among ``ids`` (paper_id)."""
    return papers.join(ids.select(F.col("paper_id").alias("id")).distinct(), "id", "left_semi")
