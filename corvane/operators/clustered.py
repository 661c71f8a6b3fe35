"""Stores whose rows lie in buckets by their key: lookups and pages open the buckets they need, upserts rewrite those they touch.

A store is a folder. Its rows lie in ``data/{write}/_bucket={b}``; a version names, for each bucket, the write that
holds it and how many rows that has. Version files are made whole under names that only one writer can take,
so a reader sees one version or the next, and what a writer that was broken off has left is in no version.
Integer keys can be cut into ranges of ``width`` (pages come from buckets in order), others are hashed into ``buckets``.
Buckets are sorted by key, with Parquet's bounds on it and Bloom filters on the ids.

The driver holds one version: some 60 bytes a bucket.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_ROWS = 100_000  # that a range of keys should hold
STALE = 600  # seconds after which a version number that was claimed and not used is free again; a writer uses it at once


class Conflict(RuntimeError):
    """Another writer made the next version first; nothing was changed."""


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # Versions

    @classmethod
    def create(cls, spark: SparkSession, path: str, sample: DataFrame, key: str, width: int | None = None, buckets: int | None = None, ids: Sequence[str] = (), **properties: str) -> Store:
        """An empty store of the sample's columns; ``ids`` get Bloom filters. A FileExistsError if there is one."""
        if (width is None) == (buckets is None):
            raise ValueError("a store is cut by the width of ranges or into a number of hashed buckets")
        store = cls(spark, path)
        if not store._put(0, {"key": key, "width": width, "count": buckets, "ids": [*ids], "schema": sample.schema.jsonValue(), "properties": properties, "buckets": {}}):
            raise FileExistsError(path)
        return store

    def exists(self) -> bool:
        return bool(self._numbers())

    def _numbers(self) -> list[int]:
        folder = self.hadoop.Path(f"{self.path}/versions")
        return sorted(int(s.getPath().getName()[:-5]) for s in self.fs.listStatus(folder) if s.getPath().getName().endswith(".json")) if self.fs.exists(folder) else []

    def _put(self, number: int, version: dict) -> bool:
        """Makes the version's file, whole, unless there is one of that number."""
        target, part = (self.hadoop.Path(f"{self.path}/versions/{name}") for name in (f"{number:012d}.json", f".{uuid.uuid4().hex}"))
        out = self.fs.create(part, True)
        out.write(bytearray(json.dumps(version).encode()))
        out.close()
        claim = self.hadoop.Path(f"{self.path}/versions/.claim-{number:012d}")
        try:
            self.fs.create(claim, False).close()  # only one can
        except Py4JJavaError:
            if self.fs.exists(target) or not self._stale(claim):
                self.fs.delete(part, False)
                return False
        made = not self.fs.exists(target) and self.fs.rename(part, target)
        self.fs.delete(part, False)
        return bool(made)

    def _stale(self, claim) -> bool:
        return time.time() - self.fs.getFileStatus(claim).getModificationTime() / 1000 > STALE

    def version(self) -> tuple[int, dict]:
        numbers = self._numbers()
        if not numbers:
            raise FileNotFoundError(self.path)
        stream = self.fs.open(self.hadoop.Path(f"{self.path}/versions/{numbers[-1]:012d}.json"))
        try:
            return numbers[-1], json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    # Reading

    def _bucket(self, version: dict) -> Column:
        key, width = f"`{version['key']}`", version["width"]
        return F.expr(f"({key} - pmod({key}, {width}L)) div {width}L" if width else f"pmod(xxhash64({key}), {version['count']}L)")

    def _frame(self, version: dict, buckets: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(version["schema"])
        paths = [f"{self.path}/data/{version['buckets'][b]['write']}/_bucket={b}" for b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        version = self.version()[1]
        return self._frame(version, [*version["buckets"]])

    def properties(self) -> dict[str, str]:
        return self.version()[1]["properties"]

    def rows(self) -> int:
        return sum(b["rows"] for b in self.version()[1]["buckets"].values())

    def lookup(self, key) -> DataFrame:
        """The row of one key, from the one bucket that can hold it."""
        version = self.version()[1]
        kind = T.StructType.fromJson(version["schema"])[version["key"]].dataType
        b = str(key // version["width"] if version["width"] else self.spark.range(1).select(F.lit(key).cast(kind).alias(version["key"])).select(self._bucket(version)).first()[0])
        return self._frame(version, [b] if b in version["buckets"] else []).where(F.col(version["key"]) == F.lit(key))

    def scroll(self, n: int, after: int | None = None) -> DataFrame:
        """The next ``n`` rows by key after a cursor, from as many buckets as hold them."""
        version = self.version()[1]
        if not version["width"]:
            raise ValueError("a hashed store has no order to page through")
        left, chosen = n, []
        for b in sorted(map(int, version["buckets"])):
            if after is None or (b + 1) * version["width"] > after + 1:
                chosen.append(str(b))
                if after is None or b * version["width"] > after:  # all its rows come after the cursor
                    left -= version["buckets"][str(b)]["rows"]
                if left <= 0:
                    break
        rows = self._frame(version, chosen)
        return (rows if after is None else rows.where(F.col(version["key"]) > after)).orderBy(version["key"]).limit(n)

    # Writing

    def upsert(self, new: DataFrame, order: str | None = None) -> list[int]:
        """Puts rows in or in the place of those with their key, and tells the buckets that were rewritten.

        Of rows with one key the last counts, by ``order``, or where none is given by the frame's own order; rows
        without a key are a ValueError. Other buckets stay as they are. Broken off anywhere, the store has its old version.
        If another writer was faster, nothing is changed and ``Conflict`` is raised.
        """
        number, version = self.version()
        key, columns = version["key"], [f["name"] for f in version["schema"]["fields"]]
        write = f"{number + 1:012d}-{uuid.uuid4().hex}"
        placed = new.withColumns({"_place": F.col(order) if order else F.monotonically_increasing_id(), "_bucket": self._bucket(version)})
        last = placed.groupBy("_bucket", key).agg(F.max_by(F.struct(*[c for c in columns if c != key]), "_place").alias("_row"))
        fresh = last.select("_bucket", *[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in columns])
        self._write(fresh, key, version, f"{write}/new")  # written, so that it is the same rows that are counted, looked for and kept
        held = self.spark.read.schema(T.StructType([*T.StructType.fromJson(version["schema"]).fields, T.StructField("_bucket", T.LongType())])).parquet(f"{self.path}/data/{write}/new")
        counts = {r["_bucket"]: (r["n"], r["lost"]) for r in held.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("lost")).collect()}  # a row a bucket
        if any(lost for _, lost in counts.values()) or None in counts:
            self._drop(write)
            raise ValueError(f"rows without {key}")
        old = [str(b) for b in counts if str(b) in version["buckets"]]
        if old:
            before = self._frame(version, old).withColumn("_bucket", self._bucket(version))
            stay = before.join(held.select("_bucket", key), ["_bucket", key], "left_anti").select(*columns, "_bucket")
            self._write(stay.unionByName(held.select(*columns, "_bucket")), key, version, f"{write}/all")
            rows = {r["_bucket"]: r["n"] for r in self.spark.read.parquet(f"{self.path}/data/{write}/all").groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
            self._drop(f"{write}/new")
        else:
            rows = {b: n for b, (n, _) in counts.items()}
        part = "all" if old else "new"
        following = version | {"buckets": version["buckets"] | {str(b): {"write": f"{write}/{part}", "rows": n} for b, n in rows.items()}}
        if not rows:
            self._drop(write)
        elif not self._put(number + 1, following):
            self._drop(write)
            raise Conflict(f"{self.path}: version {number + 1} was made by another writer")
        return sorted(rows)

    def _write(self, rows: DataFrame, key: str, version: dict, to: str) -> None:
        writer = rows.repartition("_bucket").sortWithinPartitions("_bucket", key).write.partitionBy("_bucket").option("compression", "zstd")
        for name in version["ids"]:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer.parquet(f"{self.path}/data/{to}")

    def _drop(self, write: str) -> None:
        self.fs.delete(self.hadoop.Path(f"{self.path}/data/{write}"), True)

    def vacuum(self, keep: int = 1) -> None:
        """Deletes all versions but the last ``keep``, and what none of these refers to; no writer may be at work."""
        numbers = self._numbers()
        live = set()
        for n in numbers[-keep:]:
            stream = self.fs.open(self.hadoop.Path(f"{self.path}/versions/{n:012d}.json"))
            version = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            stream.close()
            live |= {(*b["write"].split("/"), f"_bucket={i}") for i, b in version["buckets"].items()}
        for n in numbers[:-keep]:
            self.fs.delete(self.hadoop.Path(f"{self.path}/versions/{n:012d}.json"), False)
        data = self.hadoop.Path(f"{self.path}/data")
        for write in self.fs.listStatus(data) if self.fs.exists(data) else []:
            for part in self.fs.listStatus(write.getPath()):
                for bucket in self.fs.listStatus(part.getPath()):
                    if (write.getPath().getName(), part.getPath().getName(), bucket.getPath().getName()) not in live:
                        self.fs.delete(bucket.getPath(), True)
                if not any(s.isDirectory() for s in self.fs.listStatus(part.getPath())):
                    self.fs.delete(part.getPath(), True)
            if not self.fs.listStatus(write.getPath()):
                self.fs.delete(write.getPath(), True)


class PaperStore:
    """Points by ``point_id`` in ranges, with an index from ``paper_id``: two buckets are opened for either."""

    def __init__(self, spark: SparkSession, path: str):
        self.points, self.index = Store(spark, f"{path}/points"), Store(spark, f"{path}/index")

    @classmethod
    def create(cls, spark: SparkSession, path: str, sample: DataFrame, width: int = BUCKET_ROWS, buckets: int = 64, metric: str = "cosine") -> PaperStore:
        """An empty store of the sample's columns, ``point_id`` and ``paper_id`` among them."""
        store = cls(spark, path)
        Store.create(spark, store.points.path, sample, "point_id", width=width, ids=["paper_id"], metric=metric)
        Store.create(spark, store.index.path, sample.select("paper_id", "point_id"), "paper_id", buckets=buckets)
        return store

    def upsert(self, new: DataFrame, order: str | None = None) -> list[int]:
        """Points first, then the index: an entry of the index is believed only if the point says the same."""
        done = self.points.upsert(new, order)
        self.index.upsert(new.where("paper_id is not null").select("paper_id", "point_id"), "point_id")
        return done

    def of_paper(self, paper_id: str) -> DataFrame:
        """The paper's point, the last one that was put in; no row if there is none."""
        found = self.index.lookup(paper_id).first()
        return self.points.lookup(found["point_id"] if found else -1).where(F.col("paper_id") == paper_id)

    def of_point(self, point_id: int) -> DataFrame:
        return self.points.lookup(point_id)

    def scroll(self, n: int, after: int | None = None) -> DataFrame:
        return self.points.scroll(n, after)
