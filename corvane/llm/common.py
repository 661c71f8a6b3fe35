"""What the operators of this subpackage share: tables, the shared folder, ranks, column names."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import mapped  # noqa: F401

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only in a local session where it is unset, as in tests, a temporary folder is made and set; on a
    cluster executors would each write to a disk of their own, so there it must be set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = known.get() if known.isDefined() else None
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="corvane-")
        atexit.register(shutil.rmtree, found, True)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors.

    ``keep`` writes a frame and reads it back. ``drop`` deletes tables as soon as nothing reads them
    any more; tables that a result still reads stay until the driver's Python ends, or until ``clear``.
    Inside ``with scratch.owning():`` operators put their tables below this one's folder, so who has
    written an operator's result elsewhere can ``clear`` that operator's tables, and only those.
    """

    _owner: ClassVar[ContextVar[Scratch | None]] = ContextVar("owner", default=None)
    _made: ClassVar[list[Scratch]] = []  # roots without an owner, deleted at the end

    def __init__(self, spark: SparkSession):
        owner = Scratch._owner.get()
        self.spark, self.root = spark, f"{owner.root if owner else shared_folder(spark)}/corvane-{uuid.uuid4().hex}"
        self.count = 0
        if owner is None:
            Scratch._made.append(self)

    @contextmanager
    def owning(self):
        before = Scratch._owner.set(self)
        try:
            yield self
        finally:
            Scratch._owner.reset(before)

    def keep(self, df: DataFrame, *partition: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.partitionBy(*partition).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._corvane_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            self._delete(df._corvane_path)

    def drop_others(self, *kept: DataFrame) -> None:
        """Deletes all tables of this object but these."""
        stay = {df._corvane_path for df in kept}
        for number in range(1, self.count + 1):
            if f"{self.root}/{number}" not in stay:
                self._delete(f"{self.root}/{number}")

    def clear(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(there, True)

    @classmethod
    def clear_all(cls) -> None:
        for scratch in cls._made:
            with suppress(Exception):  # the session may be gone
                scratch.clear()
        cls._made.clear()


atexit.register(Scratch.clear_all)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, rows: int) -> DataFrame:
    """Adds ``out``: the row's place from 0, without gaps, among the rows with its ``keys``.

    A key may hold a third of all rows, so no task may see a whole key: each key's rows are dealt
    by a hash of ``order`` into buckets, ranked in the bucket, and moved by the summed counts of
    the buckets before. ``df`` is read twice, so it should be a written table; ``rows`` is its
    size, from which the number of buckets follows.
    """
    buckets = 16 + rows // 100_000
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    moved = sizes.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_bucket").alias("_b"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_bucket") == F.col("_b")]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return (
        dealt.withColumn("_within", F.row_number().over(inside) - 1)
        .join(moved, condition)
        .withColumn(out, (F.col("_within") + F.col("_before")).cast("long"))
        .drop("_bucket", "_within", "_before", "_b", *[f"_{k}" for k in keys])
    )


MOST_BITS = 1 << 29  # of a bitmap that is broadcast: 64 MB
_ROW_BITS = 32_768  # that one row of a bitmap holds


def few_of(df: DataFrame, column: str, ids: DataFrame, n: int) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be among the ``n`` values of the first column of ``ids``, a written table.

    None that is among them is lost, and nearly none of the others stays: a bitmap of the values' hashes with
    128 bits a value, MOST_BITS at most, is broadcast. So a join with ``ids`` after it shuffles few rows. With
    more than MOST_BITS / 128 values more of the others stay; the result of the join is the same.
    """
    rows = max(1, min(MOST_BITS, 1 << (128 * max(1, n) - 1).bit_length()) // _ROW_BITS)
    place = F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(rows * _ROW_BITS))
    bits = ids.select(place.alias("_p")).groupBy(F.expr(f"_p div {_ROW_BITS}").alias("_row")).agg(F.bitmap_construct_agg(F.expr(f"_p % {_ROW_BITS}")).alias("_bits"))
    own = F.pmod(F.xxhash64(F.col(column)), F.lit(rows * _ROW_BITS))
    joined = df.withColumn("_p", own).withColumn("_row", F.expr(f"_p div {_ROW_BITS}")).join(F.broadcast(bits), "_row")  # rows * 4 KB
    byte = F.conv(F.hex(F.expr(f"substring(_bits, CAST((_p % {_ROW_BITS}) div 8 + 1 AS INT), 1)")), 16, 10).cast("int")
    return joined.where(byte.bitwiseAND(F.expr("shiftleft(1, CAST(_p % 8 AS INT))")) > 0).select(*df.columns)


LONG, STRING, DOUBLE, BOOLEAN, BINARY = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType(), T.BinaryType()


def schema(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])
