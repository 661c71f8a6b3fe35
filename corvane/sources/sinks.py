"""Writers: vector tables, sidecars, reports, id lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vector as V
from ..functions.text import percent
from ..session import mapped
from .hdf5 import as_path


def append_vectors(vectors: DataFrame, path: str, rows_per_file: int | None = None, codec: str = "zstd") -> None:
    """Appends to a vector table; ``rows_per_file`` makes numbered part files of bounded size."""
    writer = vectors.write.mode("append").option("compression", codec)
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)


def write_parts_by_file(rows: DataFrame, path: str, file: str = "file") -> None:
    """One folder a source file, in place of one workbook a file."""
    rows.write.mode("overwrite").partitionBy(file).parquet(path)


SHEET_ROWS = 1_048_575  # fixed value: what a sheet takes besides its header
_SHEET_START = '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
_BOOK = {
    "[Content_Types].xml": '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Sheet1" sheetId="1" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}  # fixed values: the parts of a workbook with one sheet


def write_workbooks(rows: DataFrame, folder: str, file: str = "file") -> DataFrame:
    """workbook, rows: one XLSX workbook a source file below ``folder``, which all executors see as a path.

    The rows of a file are sorted together and written one by one, so no file is held whole. A file with
    more rows than a sheet takes goes on in further workbooks. A workbook is written under another name and
    then takes its own, so a task that is run again leaves whole ones. Cells are text; a null is an empty cell.
    """
    columns, folder = [c for c in rows.columns if c != file], as_path(folder)

    def work(frames):
        import os
        import re
        import time
        import zipfile
        from xml.sax.saxutils import escape

        import pyarrow as pa

        odd = re.compile("[^\t\n\r -\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")  # what XML cannot hold
        made, now = [], None
        os.makedirs(folder, exist_ok=True)

        def line(values):
            return f"<row>{''.join(f'<c t=\"inlineStr\"><is><t xml:space=\"preserve\">{escape(odd.sub("", v or ""))}</t></is></c>' for v in values)}</row>".encode()

        def close():
            name, book, sheet, part, n = now
            sheet.write(b"</sheetData></worksheet>")
            sheet.close()
            book.close()
            os.replace(part, f"{folder}/{name}")
            made.append((name, n))

        for frame in frames:
            for source, *values in zip(frame.column(0).to_pylist(), *(frame.column(i + 1).to_pylist() for i in range(len(columns)))):
                if now is None or key != source or now[4] >= SHEET_ROWS:
                    number = number + 1 if now is not None and key == source else 0
                    if now is not None:
                        close()
                    key, name = source, f"{source}{f'.{number}' if number else ''}.xlsx"
                    part = f"{folder}/{name}.{os.getpid()}.{time.time_ns()}.part"
                    book = zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED)
                    for path, text in _BOOK.items():
                        book.writestr(path, text)
                    sheet = book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
                    sheet.write(_SHEET_START.encode() + line(columns))
                    now = [name, book, sheet, part, 0]
                now[2].write(line(values))
                now[4] += 1
        if now is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], names=["workbook", "rows"])

    texts = rows.select(F.col(file).cast("string"), *[F.col(c).cast("string") for c in columns])
    return texts.repartition(file).sortWithinPartitions(file).mapInArrow(work, "workbook string, rows bigint")


def run_info(results: DataFrame | dict[str, float], model: str, dim: int, prompt_name: str | None = None, batch_size: int = 50, method: str = "sliding_window", created: str | None = None) -> DataFrame:
    """One row of counts and settings of an embedding run.

    ``results`` are the counts of the pass that wrote it (``embed.write_results``); of a frame with ``error``, null where it
    worked, they are made by one more pass.
    """
    if isinstance(results, DataFrame):
        failures = F.col("error").isNotNull()
        results = results.agg(F.count_if(~failures).alias("succeeded"), F.count_if(failures).alias("failed")).first().asDict()
    counts = results
    ok, failed, seconds = F.lit(int(counts["succeeded"])).cast("long"), F.lit(int(counts["failed"])).cast("long"), F.lit(float(counts.get("seconds", 0.0)))
    return SparkSession.active().range(1).select(
        F.lit(model).alias("model"), F.lit(dim).alias("embedding_dim"), (F.lit(created) if created else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).alias("creation_date"), F.lit(prompt_name).alias("prompt_name"),
        ok.alias("total_papers"), failed.alias("failed_papers"), percent(ok, ok + failed).alias("success_rate"), F.lit(method).alias("processing_method"), F.lit("float32").alias("data_type"), F.lit("zstd").alias("compression"), F.lit(batch_size).alias("batch_size"),
        F.coalesce(F.try_divide((ok + failed).cast("double"), seconds), F.lit(0.0)).alias("papers_per_second"),
    )


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_lines(rows: DataFrame, path: str, column: str) -> None:
    """One text column as lines: filtered JSON lines, id lists."""
    rows.select(F.col(column).cast("string").alias("value")).where("value is not null").write.mode("overwrite").text(path)


def write_ids(ids: DataFrame, folder: str, column: str = "paper_id") -> None:
    """An id list as text, JSON and CSV below ``folder``."""
    write_lines(ids, f"{folder}/txt", column)
    ids.select(column).write.mode("overwrite").json(f"{folder}/json")
    ids.select(column).write.mode("overwrite").option("header", True).csv(f"{folder}/csv")


def sample_rows(vectors: DataFrame, n: int = 100) -> DataFrame:
    """paper_id, norms and similarity of a reproducible sample, for export."""
    some = vectors.orderBy(F.md5(F.col("paper_id").cast("binary")), "paper_id").limit(n)
    return some.select("paper_id", V.norm("title_embedding").alias("title_norm"), V.norm("abstract_embedding").alias("abstract_norm"), V.cosine("title_embedding", "abstract_embedding").alias("similarity"))


def export_sample(vectors: DataFrame, folder: str, n: int = 100) -> None:
    sample_rows(vectors, n).write.mode("overwrite").option("header", True).csv(f"{folder}/csv")
    vectors.orderBy(F.md5(F.col("paper_id").cast("binary")), "paper_id").limit(n).write.mode("overwrite").parquet(f"{folder}/vectors")


SIDECAR_PAPERS = 1_000_000  # that one document may hold


def metadata_sidecar(papers: DataFrame, info: DataFrame, most: int = SIDECAR_PAPERS) -> DataFrame:
    """One row: papers, id_to_index, embedding_info, the nested document of small runs.

    A document is one value: with more than ``most`` papers it is a ValueError; ``write_sidecar_parts`` writes
    those of large runs.
    """
    if (n := papers.count()) > most:
        raise ValueError(f"{n} papers are too many for one document of {most}; keep them as a table")
    fields = F.struct(*[c for c in papers.columns if c != "row_index"])
    listed = papers.agg(F.transform(F.array_sort(F.collect_list(F.struct("row_index", fields.alias("p")))), lambda s: s["p"]).alias("papers"))
    places = papers.groupBy("id").agg(F.max("row_index").alias("i")).agg(F.map_from_entries(F.collect_list(F.struct("id", "i"))).alias("id_to_index"))
    return listed.crossJoin(places).crossJoin(info.limit(1).select(F.struct("*").alias("embedding_info")))  # one row each


def write_sidecar(sidecar: DataFrame, path: str) -> None:
    """Writes the document to ``path`` + ``.temp`` and then gives it its name: a reader never meets a part of it."""
    write_json(sidecar, f"{path}.temp")
    _take_name(sidecar.sparkSession, path)


def _take_name(spark: SparkSession, path: str) -> None:
    part, whole = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.temp", path))
    fs = whole.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(whole, True)
    if not fs.rename(part, whole):
        raise OSError(f"{path}.temp cannot be renamed")


def write_sidecar_parts(papers: DataFrame, info: DataFrame, path: str) -> None:
    """Writes the sidecar of a run of any size: a folder of JSON documents, each with a part of papers or of id_to_index, or with embedding_info.

    The papers are in order of row_index, file by file in order of their names. No list is one value, and no task holds more of
    it than a batch. A paper without an id has no place. The folder takes its name when it is whole, as ``write_sidecar``.
    """
    fields = [c for c in papers.columns if c != "row_index"]
    ordered = papers.repartitionByRange("row_index").sortWithinPartitions("row_index", *fields).select(F.to_json(F.struct(*fields)).alias("value"))
    places = papers.where("id is not null").groupBy(F.col("id").cast("string").alias("id")).agg(F.max("row_index").alias("i"))
    entry = F.to_json(F.create_map("id", "i"))
    _documents(ordered, '{"papers":[', "]}").write.mode("overwrite").text(f"{path}.temp")
    _documents(places.select(F.substr(entry, F.lit(2), F.length(entry) - 2).alias("value")), '{"id_to_index":{', "}}").write.mode("append").text(f"{path}.temp")
    _documents(info.limit(1).select(F.to_json(F.struct("*")).alias("value")), '{"embedding_info":', "}").write.mode("append").text(f"{path}.temp")
    _take_name(papers.sparkSession, path)


def _documents(elements: DataFrame, head: str, foot: str) -> DataFrame:
    """The lines of a JSON document a partition, of its elements (value) between ``head`` and ``foot``; none of an empty one."""

    def work(frames):
        import pyarrow as pa

        mark = head
        for frame in frames:
            if frame.num_rows:
                first, *others = frame.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([mark + first, *("," + v for v in others)], pa.string())], names=["value"])
                mark = ","
        if mark != head:
            yield pa.RecordBatch.from_arrays([pa.array([foot], pa.string())], names=["value"])

    return mapped(elements, work, "value string")
