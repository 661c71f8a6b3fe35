"""NPZ parts (arrays ``ids`` and ``embeddings``) as a Spark data source: partitions are row slabs.

Planning reads each part's directory and array headers. A task goes to its rows: at once where the part was
stored plainly, by unpacking what lies before where it was compressed; it holds ``STEP`` rows at a time.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from .hdf5 import SLAB_ROWS, Slab, files_of, open_file

PARTS = "part string, pos bigint, paper_id string, embedding array<float>"
STEP = 1000  # rows that are read together
IDS, VECTORS = "ids.npy", "embeddings.npy"


class Member:
    """An array in an open part, read by rows."""

    def __init__(self, part: zipfile.ZipFile, name: str):
        if name not in part.namelist():
            raise ValueError(f"there is no array {name[:-4]}, but {', '.join(n.removesuffix('.npy') for n in part.namelist())}")
        self.file, form = part.open(name), np.lib.format
        header = {(1, 0): form.read_array_header_1_0, (2, 0): form.read_array_header_2_0}.get(form.read_magic(self.file))
        if header is None:
            raise ValueError(f"{name}: a header of this version is not read")
        self.shape, by_column, self.dtype = header(self.file)
        if self.dtype.hasobject or by_column and len(self.shape) > 1:
            raise ValueError(f"{name}: arrays of objects, and those that are stored by column, are not read")
        self.begin, self.width = self.file.tell(), self.dtype.itemsize * int(np.prod(self.shape[1:], dtype=int))

    def rows(self, start: int, stop: int) -> np.ndarray:
        self.file.seek(self.begin + start * self.width)
        body = b""
        while len(body) < (stop - start) * self.width:  # a read may give less
            more = self.file.read((stop - start) * self.width - len(body))
            if not more:
                raise ValueError("the array ends before its rows do")
            body += more
        return np.frombuffer(body, self.dtype).reshape(stop - start, *self.shape[1:])


class NpzReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.names, self.paths, self.slab = schema.names, options["paths"].split("\n"), int(options.get("slabRows", SLAB_ROWS))

    def partitions(self) -> list[Slab]:
        out = []
        for path in self.paths:
            with open_file(path) as f, zipfile.ZipFile(f) as part:
                lengths = [Member(part, n).shape[0] for n in (IDS, VECTORS)]
            if lengths[0] != lengths[1]:
                raise ValueError(f"{path}: {lengths[0]} ids of {lengths[1]} vectors")
            out += [Slab(path, 0, a, min(lengths[0], a + self.slab)) for a in range(0, lengths[0], self.slab)]
        return out or [Slab(self.paths[0], 0, 0, 0)]  # one at least: with none the reader would be asked for no slab

    def read(self, slab: Slab) -> Iterator[pa.RecordBatch]:
        with ExitStack() as held:  # a file for each array: places in one file would get mixed up

            def member(name: str) -> Member:
                return Member(held.enter_context(zipfile.ZipFile(held.enter_context(open_file(slab.path)))), name)

            ids, vectors = (member(n) if c in self.names else None for n, c in ((IDS, "paper_id"), (VECTORS, "embedding")))
            for start in range(slab.start, slab.stop, STEP):
                stop = min(slab.stop, start + STEP)
                yield pa.RecordBatch.from_arrays([self._column(name, slab.path, ids, vectors, start, stop) for name in self.names], names=self.names)

    def _column(self, name: str, path: str, ids: Member | None, vectors: Member | None, start: int, stop: int) -> pa.Array:
        n = stop - start
        if name == "part":
            return pa.array([path] * n, pa.string())
        if name == "pos":
            return pa.array(np.arange(start, stop), pa.int64())
        if name == "paper_id":
            return pa.array([i.decode() if isinstance(i, bytes) else str(i) for i in ids.rows(start, stop).tolist()], pa.string())
        flat = vectors.rows(start, stop).reshape(n, -1).astype(np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * flat.shape[1], pa.int32()), pa.array(flat.ravel()))


class NpzSource(DataSource):
    """``spark.read.format("npz_slabs")`` with options ``paths`` (a line each) and ``slabRows``; the schema chooses what is read."""

    @classmethod
    def name(cls) -> str:
        return "npz_slabs"

    def schema(self) -> str:
        return PARTS

    def reader(self, schema) -> NpzReader:
        return NpzReader(schema, self.options)


def read_npz(spark: SparkSession, *paths: str, slab_rows: int = SLAB_ROWS, columns: str = PARTS) -> DataFrame:
    """part, pos, paper_id, embedding of numbered NPZ parts; half precision is widened. Without ``embedding`` among the columns no vector is read."""
    spark.dataSource.register(NpzSource)
    return spark.read.format("npz_slabs").schema(columns).option("paths", "\n".join(files_of(spark, *paths))).option("slabRows", slab_rows).load()
