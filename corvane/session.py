"""A session with the settings that the engine's results rely on: UTC, ANSI arithmetic, adaptive plans."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = known.get() if known.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        made = tempfile.mkdtemp(prefix="corvane-")
        atexit.register(shutil.rmtree, made, True)
        spark.sparkContext.setCheckpointDir(made)  # so whatever else asks the session finds the same
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """A file or folder, with what is in it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def session(name: str = "corvane", master: str | None = None, **more: str) -> SparkSession:
    """``master`` and ``more`` (dots written as double underscores) are for local runs; a cluster sets its own."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("__", "."): v for k, v in more.items()})
    return (builder.master(master) if master else builder).getOrCreate()


BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def mapped(df: DataFrame, work: Callable, out: T.StructType | str) -> DataFrame:
    """``df.mapInArrow(work, out)`` with batches of bounded size.

    Spark's own bounds are 10,000 rows and 256 MB, which two tasks of an executor with their Python
    workers hold several times over. The session's are lowered to BATCH_ROWS and BATCH_BYTES, unless
    they are lower already; a single longer text makes a batch of its own.
    """
    if isinstance(df, DataFrame):  # tests put in others
        conf = df.sparkSession.conf
        for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
            now = re.fullmatch(r"(-?\d+)([kmg]?)b?", conf.get(key).lower())
            if not now or not 0 < int(now[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[now[2]] <= most:
                conf.set(key, str(most))
    return df.mapInArrow(work, out)
