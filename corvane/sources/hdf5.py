"""HDF5 vector stores as a Spark data source: partitions are row slabs, and only their chunks are read.

A store has ``paper_ids`` and datasets like ``title_embeddings`` with one row a paper. Planning reads each
file's headers (some kilobytes). A task then walks the chunk index down to the chunks that meet its slab
and decodes those, one at a time; datasets that are not asked for are not touched. Read are plain groups,
chunked and contiguous datasets of floats, integers and text, with gzip, shuffle and checksum filters: what
the common libraries write by default. Files of the newest layouts (dense groups, version-4 chunk indexes)
are a ValueError that says so.

Paths are local ones, or URIs of stores that ``pyarrow.fs`` opens; all executors must reach them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SLAB_ROWS = 10_000
IDS, SUFFIX = "paper_ids", "_embeddings"

# Signatures and numbers of the file format.
_SIGNATURE, _UNDEFINED = b"\x89HDF\r\n\x1a\n", 0xFFFFFFFFFFFFFFFF
_DATASPACE, _LINK, _DATATYPE, _FILL, _LAYOUT, _FILTERS, _CONTINUED, _GROUP = 1, 6, 3, 5, 8, 11, 16, 17
_GZIP, _SHUFFLE, _CHECKSUM = 1, 2, 3


class Dataset(NamedTuple):
    shape: tuple[int, ...]
    dtype: str | None  # of the numbers; None: text of any length, kept in heaps
    width: int  # bytes of an element
    chunk: tuple[int, ...] | None  # None: contiguous
    address: int
    filters: tuple[tuple[int, int], ...]  # (filter, its first parameter)
    fill: bytes


def as_path(uri: str) -> str:
    """A ``file:`` URI as the path that it names; others stay."""
    return "/" + uri[5:].lstrip("/") if uri.startswith("file:/") else uri


def open_file(path: str):
    """A seekable binary file of a local path or of a URI."""
    scheme, _, rest = as_path(path).partition("://")
    if rest:
        from pyarrow import fs

        store, inside = fs.FileSystem.from_uri(path)
        return store.open_input_file(inside)
    return open(scheme, "rb")


class Hdf5File:
    """Datasets of the root group by name, and reading of their rows."""

    def __init__(self, file):
        self.file, self.read_bytes, self.chunks_read = file, 0, 0
        self.base = next((at for at in (0, 512, 1024, 2048) if self._at(at, 8, raw=True) == _SIGNATURE), None)
        if self.base is None:
            raise ValueError("no HDF5 signature")
        head = self._at(0, 48)
        if head[8] in (0, 1):
            sizes, roots = head[13:15], 24 + 4 * head[8] + 4 * 8 + 8  # after the addresses the root's entry: its name, its header
        elif head[8] in (2, 3):
            sizes, roots = head[9:11], 12 + 3 * 8
        else:
            raise ValueError(f"superblock version {head[8]} is unknown")
        if sizes != b"\x08\x08":
            raise ValueError("only files with offsets and lengths of 8 bytes are read")
        self.links = self._links(self._word(roots))

    def _at(self, address: int, size: int, raw: bool = False) -> bytes:
        self.file.seek(address if raw else self.base + address)
        found = self.file.read(size)
        self.read_bytes += len(found)
        return found

    def _word(self, address: int) -> int:
        return struct.unpack("<Q", self._at(address, 8))[0]

    def _messages(self, address: int) -> list[tuple[int, bytes]]:
        """(type, body) of an object header's messages, both header versions."""
        head, out = self._at(address, 16), []
        if head[:4] == b"OHDR":
            flags = head[5]
            at = address + 6 + 16 * (flags >> 5 & 1) + 4 * (flags >> 4 & 1)
            size = int.from_bytes(self._at(at, 1 << (flags & 3)), "little")
            blocks, lead = [(at + (1 << (flags & 3)), size)], 4 + 2 * (flags >> 2 & 1)
        elif head[0] == 1:
            blocks, lead = [(address + 16, struct.unpack("<I", head[8:12])[0])], 8
        else:
            raise ValueError(f"no object header at {address}")
        for start, size in blocks:  # continuations are added on the way
            body, at = self._at(start, size), 0
            while at + lead <= size:
                kind, length = struct.unpack("<HH", body[at : at + 4]) if lead == 8 else struct.unpack("<BH", body[at : at + 3])
                found = body[at + lead : at + lead + length]
                at += lead + length
                if kind == _CONTINUED:
                    place, more = struct.unpack("<QQ", found[:16])
                    blocks.append((place, more) if lead == 8 else (place + 4, more - 8))  # without signature and checksum
                out.append((kind, found))
        return out

    def _links(self, address: int) -> dict[str, int]:
        out = {}
        for kind, body in self._messages(address):
            if kind == _GROUP:
                tree, heap = struct.unpack("<QQ", body[:16])
                names = self._at(self._word(heap + 24), self._word(heap + 8))
                for at in self._group_leaves(tree):
                    n = struct.unpack("<H", self._at(at + 6, 2))[0]
                    for name, header in struct.iter_unpack("<QQ24x", self._at(at + 8, 40 * n)):
                        out[names[name : names.index(b"\0", name)].decode()] = header
            elif kind == _LINK:
                flags, at = body[1], 2
                at, hard = at + (flags >> 3 & 1), not (flags >> 3 & 1 and body[2])
                at += 8 * (flags >> 2 & 1) + (flags >> 4 & 1)
                length = int.from_bytes(body[at : at + (1 << (flags & 3))], "little")
                at += 1 << (flags & 3)
                if hard:
                    out[body[at : at + length].decode()] = struct.unpack("<Q", body[at + length : at + length + 8])[0]
        if not out:
            raise ValueError("the root group is empty, or of a layout that is not read")
        return out

    def _node(self, address: int, key: int) -> tuple[int, bytes, int]:
        """Level, entries and their number of a B-tree node."""
        head = self._at(address, 24)
        if head[:4] != b"TREE":
            raise ValueError(f"no B-tree node at {address}")
        n = struct.unpack("<H", head[6:8])[0]
        return head[5], self._at(address + 24, n * (key + 8) + key), n

    def _group_leaves(self, address: int) -> Iterator[int]:
        level, body, n = self._node(address, 8)
        for i in range(n):
            child = struct.unpack("<Q", body[16 * i + 8 : 16 * i + 16])[0]
            if level:
                yield from self._group_leaves(child)
            else:
                yield child

    def dataset(self, name: str) -> Dataset:
        if name not in self.links:
            raise ValueError(f"there is no dataset {name}, but {', '.join(sorted(self.links))}")
        found = dict(self._messages(self.links[name])[::-1])
        space, kind, layout = found[_DATASPACE], found[_DATATYPE], found[_LAYOUT]
        shape = struct.unpack(f"<{space[1]}Q", space[8 if space[0] == 1 else 4 :][: 8 * space[1]])
        dtype, width = _number_type(kind)
        if layout[0] != 3:
            raise ValueError(f"{name}: layout version {layout[0]} is not read")
        if layout[1] == 1:
            chunk, address = None, struct.unpack("<Q", layout[2:10])[0]
        elif layout[1] == 2:
            address, chunk = struct.unpack("<Q", layout[3:11])[0], struct.unpack(f"<{layout[2] - 1}I", layout[11 : 11 + 4 * (layout[2] - 1)])
        else:
            raise ValueError(f"{name}: compact datasets are not read")
        return Dataset(shape, dtype, width, chunk, address, _filters(found.get(_FILTERS)), _fill(found.get(_FILL), width))

    def rows(self, d: Dataset, start: int, stop: int) -> np.ndarray:
        """Rows [start, stop) as an array; text as bytes objects."""
        out = np.frombuffer(d.fill * ((stop - start) * int(np.prod(d.shape[1:], dtype=int))), np.dtype((np.void, d.width))).reshape(stop - start, *d.shape[1:]).copy()
        if d.chunk is None:
            if d.address != _UNDEFINED and stop > start:
                size = d.width * int(np.prod(d.shape[1:], dtype=int))
                out = np.frombuffer(self._at(d.address + start * size, (stop - start) * size), out.dtype).reshape(out.shape)
        elif d.address != _UNDEFINED:
            for place, size, skipped, address in self._chunks(d, d.address, start, stop):
                self.chunks_read += 1
                body = np.frombuffer(_decoded(self._at(address, size), d, skipped), out.dtype).reshape(d.chunk)
                low, high = max(start, place[0]), min(stop, place[0] + d.chunk[0])
                here = tuple(slice(a, min(a + c, s)) for a, c, s in zip(place[1:], d.chunk[1:], d.shape[1:]))
                out[(slice(low - start, high - start), *here)] = body[(slice(low - place[0], high - place[0]), *(slice(0, h.stop - h.start) for h in here))]
        if d.dtype:
            return out.view(np.dtype(d.dtype)).reshape(out.shape)
        return self._texts(out)

    def _chunks(self, d: Dataset, address: int, start: int, stop: int) -> Iterator[tuple[tuple[int, ...], int, int, int]]:
        """(offsets, bytes, skipped filters, address) of the chunks that hold some row of [start, stop)."""
        rank = len(d.shape)
        key = 8 + 8 * (rank + 1)
        level, body, n = self._node(address, key)
        keys = [struct.unpack(f"<II{rank}Q", body[i * (key + 8) : i * (key + 8) + 8 + 8 * rank]) for i in range(n + 1)]
        for i in range(n):
            child = struct.unpack("<Q", body[i * (key + 8) + key : (i + 1) * (key + 8)])[0]
            size, skipped, *place = keys[i]
            if place[0] >= stop:
                break
            if level:
                if i == n - 1 or keys[i + 1][2] + d.chunk[0] > start:  # what is below ends at the next key's chunk or before
                    yield from self._chunks(d, child, start, stop)
            elif place[0] + d.chunk[0] > start:
                yield tuple(place), size, skipped, child

    def _texts(self, raw: np.ndarray) -> np.ndarray:
        """The heap objects that references (length, collection, index) name; a collection is read once."""
        references = np.frombuffer(raw.tobytes(), np.dtype([("n", "<u4"), ("heap", "<u8"), ("index", "<u4")]))
        out, heaps = np.empty(len(references), object), {}
        for i, (n, heap, index) in enumerate(references.tolist()):
            if n == 0:
                out[i] = b""
                continue
            if heap not in heaps:
                heaps[heap] = self._heap(heap)
            out[i] = heaps[heap][index][:n]
        return out.reshape(raw.shape)

    def _heap(self, address: int) -> dict[int, bytes]:
        if self._at(address, 4) != b"GCOL":
            raise ValueError(f"no heap at {address}")
        body, at, out = self._at(address, self._word(address + 8)), 16, {}
        while at + 16 <= len(body):
            index, _, size = struct.unpack("<HH4xQ", body[at : at + 16])
            if index == 0:  # the free space at the end
                break
            out[index] = body[at + 16 : at + 16 + size]
            at += 16 + (size + 7) // 8 * 8
        return out


def _number_type(kind: bytes) -> tuple[str | None, int]:
    which, bits, width = kind[0] & 15, kind[1], struct.unpack("<I", kind[4:8])[0]
    order = "<>"[bits & 1]
    if which == 1 and width in (2, 4, 8):
        return f"{order}f{width}", width
    if which == 0:
        return f"{order}{'i' if bits & 8 else 'u'}{width}", width
    if which == 3:
        return f"S{width}", width
    if which == 9 and bits & 15 == 1:
        return None, width
    raise ValueError(f"datatype class {which} of {width} bytes is not read")


def _filters(body: bytes | None) -> tuple[tuple[int, int], ...]:
    if body is None:
        return ()
    out, at = [], 8 if body[0] == 1 else 2
    for _ in range(body[1]):
        number = struct.unpack("<H", body[at : at + 2])[0]
        named = body[0] == 1 or number >= 256
        length = struct.unpack("<H", body[at + 2 : at + 4])[0] if named else 0
        many = struct.unpack("<H", body[at + 4 + 2 * named : at + 6 + 2 * named])[0]
        at += 6 + 2 * named + ((length + 7) // 8 * 8 if body[0] == 1 else length)
        out.append((number, struct.unpack("<I", body[at : at + 4])[0] if many else 0))
        at += 4 * (many + (many % 2 if body[0] == 1 else 0))
    return tuple(out)


def _fill(body: bytes | None, width: int) -> bytes:
    """The value of elements that were never written: zeros, unless the file says otherwise."""
    if body is not None and body[0] in (1, 2) and (body[0] == 1 or body[3]):
        size, value = struct.unpack("<I", body[4:8])[0], body[8:]
    elif body is not None and body[0] == 3 and body[1] & 32:
        size, value = struct.unpack("<I", body[2:6])[0], body[6:]
    else:
        size, value = 0, b""
    return value[:size] if size == width else bytes(width)


def _decoded(body: bytes, d: Dataset, skipped: int) -> bytes:
    for i, (number, parameter) in reversed([*enumerate(d.filters)]):
        if skipped >> i & 1:
            continue
        if number == _GZIP:
            body = zlib.decompress(body)
        elif number == _SHUFFLE:
            width = parameter or d.width
            n = len(body) // width
            body = np.frombuffer(body, np.uint8, n * width).reshape(width, n).T.tobytes() + body[n * width :]
        elif number == _CHECKSUM:
            body = body[:-4]
        else:
            raise ValueError(f"filter {number} is not read")
    return body


class Slab(InputPartition):
    def __init__(self, path: str, first: int, start: int, stop: int):
        super().__init__((path, first, start, stop))
        self.path, self.first, self.start, self.stop = path, first, start, stop


class Hdf5Reader(DataSourceReader):
    """Columns by name: part, pos (the row in its file), row_index (over all files), paper_id, and ``{side}_embedding``."""

    def __init__(self, schema, options: dict):
        self.names, self.paths, self.slab = schema.names, options["paths"].split("\n"), int(options.get("slabRows", SLAB_ROWS))

    def datasets(self) -> dict[str, str]:
        return {n: IDS if n == "paper_id" else n.removesuffix("_embedding") + SUFFIX for n in self.names if n == "paper_id" or n.endswith("_embedding")}

    def partitions(self) -> list[Slab]:
        out, first = [], 0
        for path in self.paths:
            with open_file(path) as f:
                store = Hdf5File(f)
                known = {name: store.dataset(name) for name in {IDS, *self.datasets().values()}}
            lengths = {name: d.shape[0] for name, d in known.items()}
            if len(set(lengths.values())) > 1:
                raise ValueError(f"{path}: the datasets have different lengths: {lengths}")
            rows, whole = max(lengths.values()), max(d.chunk[0] if d.chunk else 1 for d in known.values())
            slab = -(-self.slab // whole) * whole  # so that no chunk is decoded for two slabs
            out += [Slab(path, first, a, min(rows, a + slab)) for a in range(0, rows, slab)]
            first += rows
        return out or [Slab(self.paths[0], 0, 0, 0)]  # one at least: with none the reader would be asked for no slab

    def read(self, partition: Slab) -> Iterator[pa.RecordBatch]:
        with open_file(partition.path) as f:
            store = Hdf5File(f)
            known = {column: store.dataset(name) for column, name in self.datasets().items()}
            step = max([1, *(d.chunk[0] for d in known.values() if d.chunk)])
            for start in range(partition.start, partition.stop, step):
                stop = min(partition.stop, start + step)
                yield pa.RecordBatch.from_arrays([self._column(store, partition, n, known.get(n), start, stop) for n in self.names], names=self.names)

    def _column(self, store: Hdf5File, partition: Slab, name: str, d: Dataset | None, start: int, stop: int) -> pa.Array:
        n = stop - start
        if name == "part":
            return pa.array([partition.path] * n, pa.string())
        if name in ("pos", "row_index"):
            return pa.array(np.arange(start, stop) + (partition.first if name == "row_index" else 0), pa.int64())
        rows = store.rows(d, start, stop)
        if name == "paper_id":
            return pa.array([i.decode() if isinstance(i, bytes) else str(i) for i in rows.tolist()], pa.string())
        flat = rows.reshape(n, -1).astype(np.float32)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * flat.shape[1], pa.int32()), pa.array(flat.ravel()))


class Hdf5Source(DataSource):
    """``spark.read.format("hdf5_slabs")`` with options ``paths`` (a line each) and ``slabRows``; the schema chooses what is read."""

    @classmethod
    def name(cls) -> str:
        return "hdf5_slabs"

    def schema(self) -> str:
        return _schema(("title", "abstract"))

    def reader(self, schema) -> Hdf5Reader:
        return Hdf5Reader(schema, self.options)


def _schema(sides: Sequence[str]) -> str:
    return ", ".join(["part string", "pos bigint", "row_index bigint", "paper_id string", *[f"{s}_embedding array<float>" for s in sides]])


def files_of(spark: SparkSession, *paths: str) -> list[str]:
    """Files below folders and of patterns, in order of their names."""
    hadoop, out = spark._jvm.org.apache.hadoop.fs, []
    for p in paths:
        path = hadoop.Path(p)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in fs.globStatus(path) or []:
            inside = [s for s in fs.listStatus(found.getPath()) if s.isFile()] if found.isDirectory() else [found]
            out += [s.getPath().toString() for s in inside if not s.getPath().getName().startswith(("_", "."))]
    if not out:
        raise FileNotFoundError(", ".join(paths))
    return sorted(out)


def read_hdf5(spark: SparkSession, *paths: str, sides: Sequence[str] = ("title", "abstract"), slab_rows: int = SLAB_ROWS) -> DataFrame:
    """part, pos, row_index, paper_id and the chosen sides' vectors of HDF5 stores; half precision is widened.

    ``row_index`` counts over the files in order of their names. Without sides no vector chunk is read. A file whose datasets
    differ in length is a ValueError.
    """
    spark.dataSource.register(Hdf5Source)
    return spark.read.format("hdf5_slabs").schema(_schema(sides)).option("paths", "\n".join(files_of(spark, *paths))).option("slabRows", slab_rows).load()


CHUNK_ROWS = 1000
_NODE_ENTRIES = 64  # fixed value: of a chunk index's node, where the file names no other number


class _Writer:
    """One file: chunks are appended as rows come; indexes and headers follow, the superblock is filled in last."""

    def __init__(self, file, columns: Sequence[str], dtype: str, chunk_rows: int):
        self.file, self.dtype, self.chunk_rows, self.rows = file, np.dtype(dtype), chunk_rows, 0
        self.chunks: dict[str, list[tuple[int, int, int]]] = {c: [] for c in columns}  # first row, bytes, address
        self.widths: dict[str, int] = {}
        self.held: dict[str, list] = {c: [] for c in columns}
        file.write(bytes(96))

    def _append(self, body: bytes) -> int:
        at = self.file.tell()
        self.file.write(body + bytes(-len(body) % 8))
        return at

    def add(self, ids: list[str], vectors: dict[str, np.ndarray]) -> None:
        for at in range(0, len(ids), self.chunk_rows):
            for name, values in [(IDS, ids), *vectors.items()]:
                self.held[name] += list(values[at : at + self.chunk_rows])
            if len(self.held[IDS]) >= self.chunk_rows:
                self._flush(self.chunk_rows)

    def _flush(self, n: int) -> None:
        for name, held in self.held.items():
            some, self.held[name] = held[:n], held[n:]
            if name == IDS:
                body = self._references([i.encode() for i in some])
            else:
                matrix = np.zeros((self.chunk_rows, len(some[0])), self.dtype)
                matrix[: len(some)] = some
                if self.widths.setdefault(name, matrix.shape[1]) != matrix.shape[1]:
                    raise ValueError(f"{name}: vectors of {self.widths[name]} and {matrix.shape[1]} values")
                body = zlib.compress(np.frombuffer(matrix.tobytes(), np.uint8).reshape(-1, self.dtype.itemsize).T.tobytes(), 4)
            self.chunks[name].append((self.rows, len(body), self._append(body)))
        self.rows += min(n, len(some))

    def _references(self, texts: list[bytes]) -> bytes:
        """A heap of the texts, and what refers to them."""
        body = b"".join(struct.pack("<HH4xQ", i, 1, len(t)) + t + bytes(-len(t) % 8) for i, t in enumerate(texts, 1))
        free = max(0, 4096 - 16 - len(body))
        heap = self._append(b"GCOL" + struct.pack("<B3xQ", 1, 16 + len(body) + free) + body + (struct.pack("<HH4xQ", 0, 0, free) + bytes(free - 16) if free >= 16 else bytes(free)))
        found = b"".join(struct.pack("<IQI", len(t), heap, i) for i, t in enumerate(texts, 1))
        return found + bytes(16 * (self.chunk_rows - len(texts)))

    def _index(self, name: str, rank: int) -> int:
        """The chunk index, leaves first; a node has room for all the entries that it could hold."""
        entries, level = [(struct.pack(f"<II{rank + 1}Q", size, 0, row, *[0] * rank), at) for row, size, at in self.chunks[name]], 0
        last = struct.pack(f"<II{rank + 1}Q", 0, 0, -(-self.rows // self.chunk_rows) * self.chunk_rows, *[0] * rank)
        room = 24 + 8 * _NODE_ENTRIES + len(last) * (_NODE_ENTRIES + 1)
        while True:
            groups = [entries[i : i + _NODE_ENTRIES] for i in range(0, len(entries), _NODE_ENTRIES)]
            begin = self.file.tell()
            for i, group in enumerate(groups):
                left, right = begin + (i - 1) * room if i else _UNDEFINED, begin + (i + 1) * room if i + 1 < len(groups) else _UNDEFINED
                body = b"TREE" + struct.pack("<BBHQQ", 1, level, len(group), left, right) + b"".join(k + struct.pack("<Q", at) for k, at in group) + (groups[i + 1][0][0] if i + 1 < len(groups) else last)
                self._append(body + bytes(room - len(body)))
            if len(groups) == 1:
                return begin
            entries, level = [(g[0][0], begin + i * room) for i, g in enumerate(groups)], level + 1

    def _header(self, messages: list[tuple[int, bytes]]) -> int:
        body = b"".join(struct.pack("<HHB3x", kind, len(m) + -len(m) % 8, 0) + m + bytes(-len(m) % 8) for kind, m in messages)
        return self._append(struct.pack("<BxHII4x", 1, len(messages), 1, len(body)) + body)

    def _dataset(self, name: str) -> int:
        shape, chunk = ([self.rows], [self.chunk_rows]) if name == IDS else ([self.rows, self.widths[name]], [self.chunk_rows, self.widths[name]])
        rank, width = len(shape), 16 if name == IDS else self.dtype.itemsize
        space = struct.pack(f"<BBB5x{2 * rank}Q", 1, rank, 1, *shape, _UNDEFINED, *shape[1:])
        if name == IDS:
            kind = struct.pack("<B3BI", 0x19, 1, 1, 0, 16) + struct.pack("<B3BI", 0x13, 0x10, 0, 0, 1)  # UTF-8 text of any length
        else:
            bits, exponent, mantissa, bias = {2: (16, 5, 10, 15), 4: (32, 8, 23, 127)}[width]
            kind = struct.pack("<B3BIHHBBBBI", 0x11, 0x20, bits - 1, 0, width, 0, bits, mantissa, exponent, 0, mantissa, bias)
        layout = struct.pack(f"<BBBQ{rank + 1}I", 3, 2, rank + 1, self._index(name, rank), *chunk, width)
        steps = struct.pack("<BB6x", 1, 2) + struct.pack("<HHHHII", _SHUFFLE, 0, 1, 1, width, 0) + struct.pack("<HHHHII", _GZIP, 0, 1, 1, 4, 0)
        return self._header([(_DATASPACE, space), (_DATATYPE, kind), (_FILL, struct.pack("<4BI", 2, 3, 2, 1, 0)), (_LAYOUT, layout), *([(_FILTERS, steps)] if name != IDS else [])])

    def close(self) -> None:
        if self.held[IDS]:
            self._flush(self.chunk_rows)
        names, text, places = sorted(self.chunks), bytes(8), []
        headers = [self._dataset(n) for n in names]
        for n in names:
            places.append(len(text))
            text += n.encode() + bytes(8 - len(n) % 8)
        segment = self._append(text)
        heap = self._append(b"HEAP" + struct.pack("<B3xQQQ", 0, len(text), 1, segment))
        symbols = b"SNOD" + struct.pack("<BxH", 1, len(names)) + b"".join(struct.pack("<QQ24x", p, h) for p, h in zip(places, headers))
        leaf = self._append(symbols + bytes(8 + 40 * 8 - len(symbols)))
        node = b"TREE" + struct.pack("<BBHQQQQQ", 0, 0, 1, _UNDEFINED, _UNDEFINED, 0, leaf, places[-1])
        tree = self._append(node + bytes(24 + 32 * 8 + 33 * 8 - len(node)))
        root = self._header([(_GROUP, struct.pack("<QQ", tree, heap))])
        end = self.file.tell()
        self.file.seek(0)
        self.file.write(_SIGNATURE + bytes(5) + b"\x08\x08\x00" + struct.pack("<HHI4Q", 4, 16, 0, 0, _UNDEFINED, end, _UNDEFINED) + struct.pack("<QQI4xQQ", 0, root, 1, tree, heap))


def write_hdf5(vectors: DataFrame, folder: str, sides: Sequence[str] = ("title", "abstract"), dtype: str = "float16", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """file, rows: one HDF5 store a partition below ``folder``, which all executors see as a path.

    Chunks of ``chunk_rows`` rows, shuffled and gzip-compressed; a task holds one chunk. A file is written
    under another name and then takes its own, which follows from the partition, so a task that is run
    again leaves whole files. Rows need an id and all vectors, of one length in a file: else a ValueError.
    """

    folder = as_path(folder)

    def work(frames):
        import os
        import time

        from pyspark import TaskContext

        os.makedirs(folder, exist_ok=True)

        name, rows = f"part-{TaskContext.get().partitionId():05d}.h5", 0
        part = f"{folder}/.{name}.{os.getpid()}.{time.time_ns()}"
        writer = None
        for frame in frames:
            if sum(c.null_count for c in frame.columns):
                raise ValueError("a row has no id or no vector")
            if frame.num_rows:
                writer = writer or _Writer(open(part, "w+b"), [IDS, *[s + SUFFIX for s in sides]], dtype, chunk_rows)
                writer.add(frame.column(0).to_pylist(), {s + SUFFIX: [v.values.to_numpy() for v in frame.column(i + 1)] for i, s in enumerate(sides)})
                rows += frame.num_rows
        if writer:
            writer.close()
            writer.file.close()
            os.replace(part, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows], pa.int64())], names=["file", "rows"])

    return vectors.select("paper_id", *[f"{s}_embedding" for s in sides]).mapInArrow(work, "file string, rows bigint")
