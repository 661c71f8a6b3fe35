"""NPZ parts in slabs."""

import numpy as np
import pytest

from corvane.sources import npz
from corvane.sources.stores import read_npz


@pytest.mark.parametrize("save", [np.savez, np.savez_compressed])
@pytest.mark.parametrize("kind", [np.float16, np.float32, ">f8"])
def test_slabs(spark, tmp_path, save, kind):
    v = np.random.default_rng(0).normal(size=(2500, 5)).astype(kind)
    for name, ids in (("a", np.array([f"é{i}" for i in range(2500)])), ("b", np.arange(2500)), ("c", np.array([b"x%d" % i for i in range(2500)]))):
        save(tmp_path / f"{name}.npz", ids=ids, embeddings=v, other=np.zeros(3))
    read = read_npz(spark, str(tmp_path), slab_rows=1200)
    assert read.rdd.getNumPartitions() == 9
    got = {}
    for r in read.collect():
        got.setdefault(r["part"][-5], {})[r["pos"]] = r["paper_id"], r["embedding"]
    want = v.astype(np.float32).tolist()
    for name, text in (("a", "é{}"), ("b", "{}"), ("c", "x{}")):
        assert got[name] == {i: (text.format(i), want[i]) for i in range(2500)}
    assert read_npz(spark, str(tmp_path / "b.npz"), columns="paper_id string, pos bigint").where("pos = 7").first()["paper_id"] == "7"


def test_faults_are_named(spark, tmp_path):
    np.savez(tmp_path / "a.npz", ids=np.array(["a"]), embeddings=np.zeros((2, 3)))
    np.savez(tmp_path / "b.npz", ids=np.array(["a"], object), embeddings=np.zeros((1, 3)))
    np.savez(tmp_path / "c.npz", embeddings=np.zeros((1, 3)))
    np.savez(tmp_path / "d.npz", ids=np.array(["a", "b"]), embeddings=np.asfortranarray(np.zeros((2, 3))))
    np.savez(tmp_path / "e.npz", ids=np.array([], "U1"), embeddings=np.zeros((0, 3), np.float32))
    for name, says in (("a", "1 ids of 2 vectors"), ("b", "arrays of objects"), ("c", "no array ids"), ("d", "by column")):
        with pytest.raises(Exception, match=says):
            read_npz(spark, str(tmp_path / f"{name}.npz")).count()
    assert read_npz(spark, str(tmp_path / "e.npz")).count() == 0 and npz.PARTS.startswith("part")
