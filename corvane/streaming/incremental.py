"""Incremental embedding: new JSON-line files are read as a stream, embedded and appended once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.embed import Embedder, embed_papers, failures, succeeded, write_results
from ..operators.reconcile import not_yet_embedded
from ..sources.papers import parsed, valid
from ..sources.stores import appending, next_position, with_positions


def paper_stream(spark: SparkSession, folder: str, files_at_once: int | None = 16, bytes_at_once: str | None = None) -> DataFrame:
    """Valid papers of the JSON-line files that appear in a folder.

    A micro-batch is flushed with so many files, or with so many bytes of them (``512m``); one of both.
    """
    bound = ("maxBytesPerTrigger", bytes_at_once) if bytes_at_once else ("maxFilesPerTrigger", files_at_once or 16)
    return valid(parsed(spark.readStream.option(*bound).text(folder)))


def embed_stream(papers: DataFrame, store: str, failed: str, checkpoint: str, make: Callable[[], Embedder], concurrency: int = 1, once: bool = True) -> StreamingQuery:
    """Appends vectors with their places to ``store`` and failures to ``failed``, a folder a batch; counts go to ``failed``.runs.

    The checkpoint replaces offsets as the place to resume from. A batch's results are written once, beside the
    checkpoint, and store and failures are made from them; a batch that is run again finds them there if they are whole, and
    calls the model no more. What it had stored is left out, and its own failures are replaced, so a paper is stored once and
    fails once a batch. Papers that failed are tried again when a file brings them again: ``still_failed``
    lists those without a vector, ``reconcile.retry_input`` makes such a file.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark, written = rows.sparkSession, f"{checkpoint}.results/{number}"
        hadoop = spark._jvm.org.apache.hadoop.fs
        fs = hadoop.Path(written).getFileSystem(spark._jsc.hadoopConfiguration())
        with appending(spark, store, checkpoint) as start:
            stored = spark.read.parquet(store).select("paper_id") if start else None
            if not fs.exists(hadoop.Path(f"{written}/_SUCCESS")):
                new = rows.dropDuplicates(["id"])
                counts = write_results(embed_papers(new if stored is None else not_yet_embedded(new, stored), make, concurrency), written)
                spark.createDataFrame([(number, int(counts["succeeded"]), int(counts["failed"]), float(counts["seconds"]))], RUNS).write.mode("overwrite").parquet(f"{failed}.runs/run={number}")
            results = spark.read.parquet(written)
            failures(results).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{failed}/run={number}")
            good = succeeded(results)
            if stored is not None:  # what this batch had stored before it was broken off
                good = good.join(stored, "paper_id", "left_anti")
            with_positions(good, F.pmod(F.xxhash64("paper_id"), F.lit(1 << 40)), start=start, width=1 << 34).write.mode("append").parquet(store)
        fs.delete(hadoop.Path(written), True)

    writer = papers.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


RUNS = "batch bigint, succeeded bigint, failed bigint, seconds double"


def runs(spark: SparkSession, failed: str) -> DataFrame:
    """batch, succeeded, failed, seconds and papers_per_second of each batch, as counted while it was written."""
    return spark.read.schema(RUNS).parquet(f"{failed}.runs/run=*").withColumn("papers_per_second", F.try_divide(F.col("succeeded") + F.col("failed"), F.col("seconds")))


def still_failed(spark: SparkSession, store: str, failed: str) -> DataFrame:
    """paper_id, error (the last) of papers that failed and have no vector since."""
    last = spark.read.parquet(failed).groupBy("paper_id").agg(F.max_by("error", "batch").alias("error"))
    return last.join(spark.read.parquet(store).select("paper_id"), "paper_id", "left_anti") if next_position(spark, store) else last


def progress(query: StreamingQuery) -> list[dict]:
    """batch, rows, rows a second of the last micro-batches."""
    return [{"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p["processedRowsPerSecond"]} for p in query.recentProgress]
