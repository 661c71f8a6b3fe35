"""Vector stores, logs and manifests: scans and what can be told from file metadata alone."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .hdf5 import read_hdf5
from .npz import read_npz  # noqa: F401

# Wordings of failure lines in logs; group 1 is the paper's id.
FAILURE_PATTERNS = [
    r"处理论文 ([^\s]+) 时出错",
    r"处理论文 ([^\s]+) 的嵌入时出错",
    r"论文 ([^\s]+) 处理失败",
    r"ERROR.*论文ID: ([^\s]+)",
    r"失败.*论文.*([0-9]{4}\.[0-9]{4,5})",
]


def read_vectors(spark: SparkSession, *paths: str) -> DataFrame:
    """Vector tables with file (in order of the paths) and row ordinals: _file, _row."""
    frames = [spark.read.parquet(p).withColumns({"_file": F.lit(i), "_row": F.col("_metadata.row_index")}) for i, p in enumerate(paths)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def with_positions(rows: DataFrame, order: Column | str, tie: str = "paper_id", start: int = 0, out: str = "row_index", width: int = 100_000) -> DataFrame:
    """``rows`` with ``out``: their places from ``start`` on, without gaps, by ``order`` (a whole number), then ``tie``.

    Rows are dealt by ranges of ``width`` of the order and numbered within; only the counts of the ranges
    meet in one task. ``rows`` is read twice, so it should be stored or persisted.
    """
    by = F.col(order) if isinstance(order, str) else order
    dealt = rows.withColumns({"_order": by, "_range": F.floor(by / width)})
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    moved = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("_order", tie)) - 1
    placed = dealt.withColumn("_inside", inside).join(moved, "_range").withColumn("_at", (F.col("_before") + F.col("_inside") + start).cast("long"))
    return placed.select(*[c for c in rows.columns if c != out], F.col("_at").alias(out))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """A vector store with ``row_index``: the stored one, or else the places of the rows in order of file name and row.

    A path that ends in ``.h5`` or ``.hdf5`` is read as HDF5 files with title and abstract vectors.

    Places that are read off the files are dense, but change when files are rewritten; ``with_positions``
    stores them with the rows.
    """
    if path.endswith((".h5", ".hdf5")):
        return read_hdf5(spark, path).drop("part", "pos")
    scan = spark.read.parquet(path)
    if "row_index" in scan.columns:
        return scan
    placed = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = scan.groupBy(F.col("_metadata.file_path").alias("_f")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    moved = counts.select("_f", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # a row a file
    return placed.join(moved, F.col("_file") == F.col("_f")).select(*scan.columns, (F.col("_before") + F.col("_row")).cast("long").alias("row_index"))


def next_position(spark: SparkSession, path: str) -> int:
    """Where the rows that are appended to a store begin: 0 if there is none."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return 0
    last = read_store(spark, path).agg(F.max("row_index")).first()[0]
    return 0 if last is None else last + 1


@contextmanager
def appending(spark: SparkSession, path: str, owner: str):
    """Where rows that ``owner`` appends to a store begin; no other may append meanwhile, else their places would collide.

    A file ``{path}.lock`` that names the owner is made, which only one can do. A run that was broken off goes on
    under its own name; of another's lock a RuntimeError tells.
    """
    lock = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.lock")
    fs = lock.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(lock, False)
        out.write(bytearray(owner.encode()))
        out.close()
    except Py4JJavaError:
        held = "".join(r["value"] for r in spark.read.text(f"{path}.lock").collect()) if fs.exists(lock) else ""
        if held != owner:
            raise RuntimeError(f"{path} is being appended to by {held or 'another run'}; if that run is gone, delete {path}.lock") from None
    try:
        yield next_position(spark, path)
    finally:
        fs.delete(lock, False)


def fetch(manifest: DataFrame, base_url: str, folder: str, retries: int = 3, opener: Callable[[str], bytes] | None = None) -> DataFrame:
    """name, bytes, error of the files of a manifest, fetched below ``folder``; one file at a time in a task.

    ``folder`` is one that all executors share and see as a path, such as a mounted store. A file is
    written under another name and then takes its own, so a task that is run again leaves whole files; files
    that are there are not fetched again. What cannot be fetched is a row with its error. The rows are
    counted once they are written: ``fetch_report``.
    """

    def work(frames):
        import os
        import time
        import urllib.request

        import pyarrow as pa

        def get(url):
            if opener:
                return opener(url)
            with urllib.request.urlopen(url, timeout=60) as answer:
                return answer.read()

        def one(name):
            target = f"{folder}/{name}"
            if os.path.exists(target):
                return name, os.path.getsize(target), None
            for attempt in range(retries):
                try:
                    content = get(f"{base_url.rstrip('/')}/{name}")
                    part = f"{target}.{os.getpid()}.{time.time_ns()}.part"
                    with open(part, "wb") as f:
                        f.write(content)
                    os.replace(part, target)
                    return name, len(content), None
                except Exception as e:  # a file's failure is a result
                    error = f"{type(e).__name__}: {e}"
                    if attempt < retries - 1:
                        time.sleep(2**attempt if opener is None else 0)
            return name, None, error

        for frame in frames:
            rows = [one(n) for n in frame.column("name").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.string()))], names=["name", "bytes", "error"])

    return manifest.select("name").mapInArrow(work, "name string, bytes bigint, error string")


def fetch_report(fetched: DataFrame) -> DataFrame:
    """succeeded, failed, bytes."""
    return fetched.agg(F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def store_structure(vectors: DataFrame) -> DataFrame:
    """name, kind, rows, dim_min, dim_max of each column, as a catalog of the store."""
    arrays = [c for c, kind in vectors.dtypes if kind.startswith("array")]
    sums = [F.count(F.lit(1)).alias("n")] + [f(F.size(c)).alias(f"{c}_{k}") for c in arrays for k, f in (("min", F.min), ("max", F.max))]
    one = vectors.agg(*sums)
    entries = [
        F.struct(F.lit(c).alias("name"), F.lit(kind).alias("kind"), F.col("n").alias("rows"), *[(F.col(f"{c}_{k}") if c in arrays else F.lit(None)).cast("int").alias(f"dim_{k}") for k in ("min", "max")])
        for c, kind in vectors.dtypes
    ]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def file_sizes(scan: DataFrame) -> DataFrame:
    """file, bytes, rows of the files behind a file scan."""
    meta = scan.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return meta.groupBy("file", "bytes").agg(F.count(F.lit(1)).alias("rows"))


def storage_report(scan: DataFrame, dim: int, bytes_per_value: int = 4) -> DataFrame:
    """rows, bytes, raw_bytes of two vectors a row, bytes a row, and the compression ratio."""
    one = file_sizes(scan).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    raw = F.col("rows") * (2 * dim * bytes_per_value)
    return one.select("rows", "bytes", raw.alias("raw_bytes"), F.try_divide("bytes", "rows").alias("bytes_per_row"), F.try_divide(raw, F.col("bytes")).alias("ratio"))


def failed_ids(lines: DataFrame, patterns: Sequence[str] = tuple(FAILURE_PATTERNS), value: str = "value") -> DataFrame:
    """Distinct ids that the patterns find in log lines."""
    found = F.flatten(F.array(*[F.regexp_extract_all(F.col(value), F.lit(p), F.lit(1)) for p in patterns]))
    return lines.select(F.explode(found).alias("paper_id")).select(F.trim("paper_id").alias("paper_id")).where("paper_id <> ''").distinct()


def read_logs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of the log files that exist; missing ones are skipped."""
    hadoop, there = spark._jvm.org.apache.hadoop.fs, []
    for p in paths:
        path = hadoop.Path(p)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            there.append(p)
    return spark.read.text(there) if there else spark.createDataFrame([], "value string")


def download_manifest(spark: SparkSession, first: int = 1, last: int = 1274, year: str = "25", have: DataFrame | None = None) -> DataFrame:
    """name, number of the yearly baseline files still to fetch; ``have`` lists names that exist."""
    wanted = spark.range(first, last + 1).select(F.format_string(f"pubmed{year}n%04d.xml.gz", "id").alias("name"), F.col("id").alias("number"))
    return wanted.join(have.select("name"), "name", "left_anti") if have is not None else wanted


def zip_parts(title: DataFrame, abstract: DataFrame) -> DataFrame:
    """paper_id, both vectors of parts (part, pos, paper_id, embedding) whose ids agree row by row.

    A part whose sides differ in any id or in length is left out whole; ``mismatched_parts`` names those.
    """
    bad = mismatched_parts(title, abstract)
    a = title.select("part", "pos", "paper_id", F.col("embedding").alias("title_embedding"))
    b = abstract.select("part", "pos", F.col("embedding").alias("abstract_embedding"))
    return a.join(bad, "part", "left_anti").join(b, ["part", "pos"]).select("part", "pos", "paper_id", "title_embedding", "abstract_embedding")


def mismatched_parts(title: DataFrame, abstract: DataFrame) -> DataFrame:
    a = title.select("part", "pos", F.col("paper_id").alias("id_a"))
    b = abstract.select("part", "pos", F.col("paper_id").alias("id_b"))
    return a.join(b, ["part", "pos"], "full_outer").where(~F.col("id_a").eqNullSafe(F.col("id_b"))).select("part").distinct()


def id_to_index(rows: DataFrame, column: str = "paper_id", position: str = "row_index") -> DataFrame:
    """id, row_index: the last place of each id."""
    return rows.groupBy(F.col(column).alias("id")).agg(F.max(position).alias("row_index"))
