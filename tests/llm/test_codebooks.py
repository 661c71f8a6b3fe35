import hashlib
import math

import numpy as np
import pytest

from corvane.llm import codebooks as C

NAN, INF = float("nan"), float("inf")
KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=4, entries=256, rounds=4):
    """All distances to all entries, in Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}, ""
    width = len(kept[0][1]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        found = [[nearest(part, books[p])[1] for p, part in enumerate(cut(v))] for _, v, _ in kept]
        for p in range(parts):
            for e in set(f[p] for f in found):
                own = [cut(v)[p] for (_, v, _), f in zip(kept, found) if f[p] == e]
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    out, by_label = [], {}
    for i, v, label in kept:
        pairs = [nearest(part, books[p]) for p, part in enumerate(cut(v))]
        out.append((i, "".join(f"{e:02x}" for _, e in pairs), sum(d for d, _ in pairs), label))
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((i if i is not None else -1, code, error, by_label[label]) for i, code, error, label in out), sha


def check(spark, rows, kind=KIND, **more):
    frame = spark.createDataFrame(rows, kind)
    plain = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]
    want, sha = brute(plain)
    got = C.digest(frame.repartition(3)).collect()
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], *r[1:4]) for r in got) == want
    assert {r["codebooks_sha256"] for r in got} == {sha}


@pytest.mark.parametrize("seed,spread", [(0, 1.0), (1, 0.002), (2, 50.0)])
def test_nearest_is_that_of_all_entries(seed, spread):
    r = np.random.default_rng(seed)
    entries, parts = (np.floor(r.normal(0, spread, (n, 5)) * 1024).astype(np.int64) for n in (256, 3000))
    tree = C.BallTree(entries)
    index, distance = tree.nearest(parts)
    every = ((parts[:, None] - entries) ** 2).sum(2)
    assert (index == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert tree.compared < every.size


def test_ties_go_to_the_lower_index():
    entries = np.array([[3, 0], [-3, 0], [0, 3], [0, -3]] * 30, np.int64)
    index, distance = C.BallTree(entries, leaf=4).nearest(np.zeros((2, 2), np.int64))
    assert index.tolist() == [0, 0] and distance.tolist() == [9, 9]
    index, _ = C.BallTree(entries[::-1].copy(), leaf=4).nearest(np.array([[3, 0], [1, 1]]))
    assert index.tolist() == [3, 1]


def test_large_components_are_compared_as_integers():
    top = C.largest_component(2)
    entries = np.array([[top, -top], [top, 1 - top], [-top, top]], np.int64)
    index, distance = C.BallTree(entries).nearest(np.array([[-top, top], [top, 2 - top]]))
    assert index.tolist() == [2, 1] and distance.tolist() == [0, 1]
    index, distance = C.BallTree(entries[:1]).nearest(entries[2:])
    assert distance.tolist() == [2 * (2 * top) ** 2]


def test_all_rows_of_a_small_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    check(spark, [(r[0], r[1], r[2] if r[0] % 7 else None) for r in rows[:400]])


def test_odd_rows(spark):
    r = np.random.default_rng(4)
    rows = [(int(i), r.normal(0, 1, 8).tolist(), int(i) % 3) for i in range(300)]
    rows += [(-1, None, 1), (-2, [None] + [0.0] * 7, 1), (-3, [NAN] + [0.0] * 7, 1), (-4, [INF] + [0.0] * 7, 2), (-5, [0.0] * 7 + [-INF], 2)]
    rows += [(5, [0.25] * 8, None), (5, [0.25] * 8, None), (None, [-0.0001] * 8, None), (7, rows[7][1], 1), (400, [300.0] * 8, 2)]
    check(spark, rows)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_rows_than_entries(spark, n):
    rows = [(i, [float(i)] * 4, None) for i in range(n)]
    if n:
        check(spark, rows)
    else:
        assert C.digest(spark.createDataFrame([(1, None, 2)], KIND)).count() == 0 and C.digest(spark.createDataFrame([], KIND)).count() == 0


def test_other_columns_and_types(spark):
    frame = spark.createDataFrame([(i, [i / 3, i / 7, 1.0, 0.5], f"l{i % 2}", "x", 1) for i in range(9)], "vec_id int, embedding array<double>, label string, code string, n int")
    got = C.digest(frame).collect()
    assert len(got) == 9 and {r["error"] for r in got} == {0} and C.digest(frame.drop("code", "n")).count() == 9
    assert {r["code"] for r in C.compress(spark.createDataFrame([(1, [], 1), (2, [], 1)], KIND))[0].collect()} == {"00000000"}


@pytest.mark.parametrize("rows", [[(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], [(1, [1.0] * 6, 1)]])
def test_lengths_that_cannot_be_cut(spark, rows):
    with pytest.raises(ValueError, match="equal parts"):
        C.digest(spark.createDataFrame(rows, KIND))
