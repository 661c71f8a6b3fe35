"""HDF5 stores: files of the library's own writer, and files of other layouts that are put together here by hand."""

import io
import struct
import zlib

import numpy as np
import pytest

from corvane.sources import hdf5 as H
from corvane.sources import stores

NONE = 0xFFFFFFFFFFFFFFFF


def store(spark, n, dim=6):
    v = np.random.default_rng(n).normal(size=(n, 2, dim)).astype(np.float32)
    rows = [(f"p{i}é" if i % 4 else "", i, v[i, 0].tolist(), v[i, 1].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "paper_id string, row_index long, title_embedding array<float>, abstract_embedding array<float>"), rows


def half(v):
    return np.array(v, np.float32).astype(np.float16).astype(np.float32).tolist()


def test_slabs_of_a_file(spark, tmp_path):
    frame, rows = store(spark, 2345)
    written = H.write_hdf5(frame.coalesce(1).sortWithinPartitions("row_index"), str(tmp_path / "a.h5"), chunk_rows=100).collect()
    assert [tuple(r) for r in written] == [("part-00000.h5", 2345)]
    read = H.read_hdf5(spark, str(tmp_path / "a.h5"), slab_rows=950)
    assert read.rdd.getNumPartitions() == 3  # of 1000 rows, whole chunks
    got = sorted(read.collect(), key=lambda r: r["row_index"])
    assert [(r["paper_id"], r["row_index"], r["title_embedding"], r["abstract_embedding"]) for r in got] == [(i, at, half(t), half(a)) for i, at, t, a in rows]


def test_places_over_files_and_stores_by_their_ending(spark, tmp_path):
    frame, rows = store(spark, 300)
    folder = str(tmp_path / "s.h5")
    assert H.write_hdf5(frame.repartitionByRange(3, "row_index").sortWithinPartitions("row_index"), f"file://{folder}", chunk_rows=7, dtype="float32").count() == 3
    got = stores.read_store(spark, folder).orderBy("row_index").collect()
    assert [tuple(r[c] for c in frame.columns) for r in got] == [tuple(r) for r in rows]


def test_ids_alone_read_no_vector_chunk(spark, tmp_path):
    frame, rows = store(spark, 500)
    H.write_hdf5(frame.coalesce(1).sortWithinPartitions("row_index"), str(tmp_path), chunk_rows=50).count()
    assert [r[0] for r in H.read_hdf5(spark, str(tmp_path), sides=()).select("paper_id").collect()] == [r[0] for r in rows]
    with open(tmp_path / "part-00000.h5", "rb") as f:
        opened = H.Hdf5File(f)
        opened.rows(opened.dataset(H.IDS), 120, 130)
        assert opened.chunks_read == 1
        opened.rows(opened.dataset("title_embeddings"), 95, 105)
        assert opened.chunks_read == 3


@pytest.mark.parametrize("n", [1, 63 * 4, 64 * 4, 64 * 4 + 1, 64 * 64 * 4 + 5])
def test_chunk_index_of_several_levels(n):
    file = io.BytesIO()
    w = H._Writer(file, [H.IDS, "title_embeddings"], "float16", 4)
    v = np.random.default_rng(1).normal(size=(n, 3)).astype(np.float16)
    ids = [str(i) for i in range(n)]
    w.add(ids, {"title_embeddings": v})
    w.close()
    f = H.Hdf5File(file)
    assert (f.rows(f.dataset("title_embeddings"), 0, n) == v).all() and f.rows(f.dataset(H.IDS), 0, n).tolist() == [i.encode() for i in ids]
    f.read_bytes = f.chunks_read = 0
    assert (f.rows(f.dataset("title_embeddings"), n - 1, n) == v[-1:]).all() and f.chunks_read == 1 and f.read_bytes < 10_000


def newer_file(datasets):
    """Superblock 2, header version 2 with a continuation, link messages; datasets: name -> (space, type, layout(address), filters, data)."""
    out = bytearray(512 + 48)  # behind a user block
    out[512:520] = H._SIGNATURE

    def append(body):
        at = len(out) - 512
        out.extend(body)
        return at

    def message(kind, body):
        return struct.pack("<BHB", kind, len(body), 0) + body

    def header(messages):
        first, rest = messages[0], b"".join(messages[1:])
        more = append(b"OCHK" + rest + bytes(4))
        body = first + message(16, struct.pack("<QQ", more, len(rest) + 8))
        return append(b"OHDR" + bytes([2, 1]) + struct.pack("<H", len(body)) + body + bytes(4))

    links = [message(2, bytes(18))]
    for name, (space, kind, layout, filters, data) in datasets.items():
        at = header([message(1, space), message(3, kind), message(8, layout(append(data) if isinstance(data, bytes) else data(append)))] + [message(11, filters)] * bool(filters))
        links.append(message(6, bytes([1, 0, len(name)]) + name.encode() + struct.pack("<Q", at)))
    root = header(links)
    out[520:560] = bytes([2, 8, 8, 0]) + struct.pack("<4Q", 512, NONE, len(out), root) + bytes(4)
    return bytes(out)


def test_newer_headers_contiguous_big_endian_and_fixed_text(spark, tmp_path):
    v = (np.arange(20).reshape(5, 4) / 7).astype(">f4")
    floats = struct.pack("<B3BIHHBBBBI", 0x11, 0x21, 31, 0, 4, 0, 32, 23, 8, 0, 23, 127)
    plain = lambda size: lambda at: struct.pack("<BBQQ", 3, 1, at, size)
    ids = b"".join(i.ljust(6, b"\0") for i in (b"a", b"bb", b"", b"dddddd", b"e"))
    body = newer_file({
        "paper_ids": (struct.pack("<BBBBQ", 2, 1, 0, 1, 5), struct.pack("<B3BI", 0x13, 0, 0, 0, 6), plain(30), b"", ids),
        "title_embeddings": (struct.pack("<BBBBQQ", 2, 2, 0, 1, 5, 4), floats, plain(80), b"", v.tobytes()),
    })
    (tmp_path / "x.h5").write_bytes(body)
    got = H.read_hdf5(spark, str(tmp_path / "x.h5"), sides=("title",), slab_rows=2).orderBy("pos").collect()
    assert [r["paper_id"] for r in got] == ["a", "bb", "", "dddddd", "e"]
    assert [r["title_embedding"] for r in got] == v.astype(np.float32).tolist()


def test_chunks_that_cut_both_dimensions_are_missing_or_skip_filters(tmp_path):
    """Chunks of 2 x 3 over 3 x 4 doubles with a fill value, gzip after shuffle, then a checksum; one chunk skips gzip, one is missing."""
    v = np.arange(12, dtype="<f8").reshape(3, 4)

    def data(append):
        keys, children = [], []
        for r in (0, 2):
            for c in (0, 3):
                if (r, c) == (2, 0):
                    continue
                whole = np.zeros((2, 3))
                part = v[r : r + 2, c : c + 3]
                whole[: part.shape[0], : part.shape[1]] = part
                body = np.frombuffer(whole.tobytes(), np.uint8).reshape(-1, 8).T.tobytes()
                skip = (r, c) == (0, 3)
                body = (body if skip else zlib.compress(body)) + b"sum!"
                keys.append(struct.pack("<IIQQQ", len(body), 2 * skip, r, c, 0))
                children.append(struct.pack("<Q", append(body)))
        last = struct.pack("<IIQQQ", 0, 0, 4, 0, 0)
        return append(b"TREE" + struct.pack("<BBHQQ", 1, 0, 3, NONE, NONE) + b"".join(k + c for k, c in zip(keys, children)) + last)

    kind = struct.pack("<B3BIHHBBBBI", 0x11, 0x20, 63, 0, 8, 0, 64, 52, 11, 0, 52, 1023)
    filters = bytes([2, 3]) + struct.pack("<HHHI", 2, 0, 1, 8) + struct.pack("<HHHI", 1, 0, 1, 6) + struct.pack("<HHH", 3, 0, 0)
    body = newer_file({"m_embeddings": (struct.pack("<BBBBQQ", 2, 2, 0, 1, 3, 4), kind, lambda at: struct.pack("<BBBQ3I", 3, 2, 3, at, 2, 3, 8), filters, data)})
    f = H.Hdf5File(io.BytesIO(body))
    want = v.copy()
    want[2, :3] = 0
    assert (f.rows(f.dataset("m_embeddings"), 0, 3) == want).all() and (f.rows(f.dataset("m_embeddings"), 1, 2) == want[1:2]).all()


def test_faults_are_named(spark, tmp_path):
    frame, _ = store(spark, 10)
    with pytest.raises(ValueError, match="signature"):
        H.Hdf5File(io.BytesIO(b"PAR1" + bytes(5000)))
    with pytest.raises(FileNotFoundError):
        H.read_hdf5(spark, str(tmp_path / "none*.h5"))
    H.write_hdf5(frame, str(tmp_path / "b")).count()
    with pytest.raises(Exception, match="there is no dataset full_embeddings"):
        H.read_hdf5(spark, str(tmp_path / "b"), sides=("full",)).count()
    with pytest.raises(Exception, match="no id or no vector"):
        H.write_hdf5(frame.selectExpr("paper_id", "if(row_index = 3, null, title_embedding) title_embedding", "abstract_embedding"), str(tmp_path / "c")).count()
    assert H.write_hdf5(frame.limit(0), str(tmp_path / "d")).count() == 0


def test_a_store_without_rows(spark, tmp_path):
    file = io.BytesIO(newer_file({"paper_ids": (struct.pack("<BBBBQ", 2, 1, 0, 1, 0), struct.pack("<B3BI", 0x13, 0, 0, 0, 6), lambda at: struct.pack("<BBQQ", 3, 1, NONE, 0), b"", b"")}))
    (tmp_path / "e.h5").write_bytes(file.getvalue())
    assert H.read_hdf5(spark, str(tmp_path / "e.h5"), sides=()).count() == 0


def test_command_line_converts_both_ways(spark, tmp_path):
    from corvane.__main__ import main

    frame, rows = store(spark, 40)
    frame.write.parquet(str(tmp_path / "v"))
    main(["convert", "--vectors", str(tmp_path / "v"), "--out", str(tmp_path / "v.h5"), "--files", "2", "--dtype", "float32"])
    main(["convert", "--vectors", str(tmp_path / "v.h5"), "--out", str(tmp_path / "w")])
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "w")).select(frame.columns).orderBy("row_index").collect()] == [tuple(r) for r in rows]
