import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import neardup as N
from corvane.llm.common import Scratch
from corvane.llm.components import components


def shingles(text, k):
    w = (text or "").encode().lower().split()
    n = min(k, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute(docs, k, percent=80):
    sets = {d: shingles(t, k) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


@pytest.fixture(scope="module")
def family():
    """Copies of one text with up to 12 changed words, exact copies, chains, and others."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    base, docs = [word() for _ in range(150)], []
    for _ in range(120):
        w = list(base)
        for _ in range(r.randint(0, 12)):
            w[r.randrange(len(w))] = word()
        docs.append(" ".join(w))
    chain = [word() for _ in range(100)]
    for _ in range(15):
        docs.append(" ".join(chain))
        chain = chain[4:] + [word() for _ in range(4)]
    docs += [docs[0]] * 20 + [" ".join(word() for _ in range(60)) for _ in range(60)] + ["", "  ", "one", "One", "a b c", "A  b\tc", None]
    r.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("block", [16, 256])
def test_components_equal_brute_force(spark, family, block, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", block)
    docs = spark.createDataFrame(family, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in N.near_duplicates(docs, words=4).collect()}
    assert got == brute(family, 4)


def test_without_leaders_blocks_find_every_link(spark, family, monkeypatch):
    monkeypatch.setattr(N, "_estimated", lambda pairs, sketch, percent: pairs.limit(0))
    docs = spark.createDataFrame(family, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in N.near_duplicates(docs, words=5).collect()}
    assert got == brute(family, 5)


def test_whole_table(spark, few_docs):
    rows = [(d["doc_id"], d["text"]) for d in few_docs.collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in N.near_duplicates(few_docs, words=4).collect()}
    assert got == brute(rows, 4)


def exact_join(docs, k, percent=80):
    """Component of each document by an exact prefix-filter join of all distinct sets, without sketches."""
    sets, parent = {d: shingles(t, k) for d, t in docs}, {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    often = Counter(g for s in set(sets.values()) for g in s)
    first, index = {}, defaultdict(list)
    for d in sorted(sets, key=lambda d: (len(sets[d]), d)):
        if not sets[d]:
            continue
        if sets[d] in first:
            parent[max(root(d), root(first[sets[d]]))] = min(root(d), root(first[sets[d]]))
            continue
        first[sets[d]], n = d, len(sets[d])
        order = sorted(sets[d], key=lambda g: (often[g], g))
        met = {e for g in order[: n - -(-n * percent // 100) + 1] for e in index[g]}
        for e in met:
            if len(sets[e]) * 100 >= n * percent:
                both = len(sets[d] & sets[e])
                if 100 * both >= percent * (n + len(sets[e]) - both):
                    x, y = sorted((root(d), root(e)))
                    parent[y] = x
        for g in order[: n - -(-n * percent // 100) + 1]:
            index[g].append(d)
    return {d: root(d) for d in sets}


def test_equals_an_exact_prefix_join(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    want = exact_join([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 5)
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(docs).select("doc_id", "component_id").collect()}
    assert got == want and len(set(want.values())) < len(want)


def test_prefix_filter_loses_no_link(spark):
    """Every class of its own component: whoever has a link stays; most of a family far apart go."""
    r, w = random.Random(6), 5
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    docs = []
    for changed in (0.02, 0.04, 0.08):
        base = [word() for _ in range(200)]
        docs += [" ".join(word() if r.random() < changed else x for x in base) for _ in range(40)]
    docs += [" ".join(word() for _ in range(r.randint(3, 300))) for _ in range(40)]
    docs += [" ".join(d.split()[: len(d.split()) * r.randint(75, 99) // 100]) for d in docs[:60]]
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    sets = N._full_sets(rows, rows.select(F.col("doc_id").alias("id")), w)
    left = rows.select(F.col("doc_id").alias("rep"), F.col("doc_id").alias("comp"))
    stay = {x["rep"] for x in N._can_meet(left, sets, 80, Scratch(spark)).collect()}
    own = [shingles(d, w) for d in docs]
    linked = {i for i in range(len(own)) for j in range(len(own)) if i != j and 100 * len(own[i] & own[j]) >= 80 * len(own[i] | own[j])}
    assert linked and linked <= stay and len(stay) < 0.75 * len(docs)
    one = left.withColumn("comp", F.lit(1).cast("long"))
    assert N._can_meet(one, sets, 80, Scratch(spark)).isEmpty()


def test_sketches_merge_and_estimate():
    r = np.random.default_rng(1)
    pool = r.integers(0, 2**63, 4000, dtype=np.uint64)
    a, b = np.unique(pool[:3000]), np.unique(pool[600:3600])
    x, y = N.registers(a), N.registers(b)
    assert (N.registers(np.union1d(a, b)) == np.maximum(x, y)).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    found = N.likely_similarity(*[np.array([v]) for v in ((x == y).sum(), (x > y).sum(), (x < y).sum(), float(len(a)), float(len(b)))])[0]
    assert abs(found - true) < 0.12
    assert N.likely_similarity(np.array([180]), np.array([0]), np.array([0]), np.array([50.0]), np.array([50.0]))[0] > 0.99
    assert N.likely_similarity(np.array([0]), np.array([90]), np.array([90]), np.array([50.0]), np.array([50.0]))[0] < 0.01


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 1999)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges, Scratch(spark)).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {2000: 1999}


def test_only_what_the_result_reads_stays(spark, few_docs):
    out = N.near_duplicates(few_docs)
    path = out.inputFiles()[0].rsplit("/", 2)[0]
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert len(fs.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(fs)) == 2 and out.count() == few_docs.count()


def test_edges(edge_docs, no_docs):
    rows = N.near_duplicates(edge_docs).collect()
    assert len(rows) == 9 and all(r["component_id"] == r["doc_id"] for r in rows) and all(r["kept"] for r in rows)
    assert {r["n_shingles"] for r in rows if r["doc_id"] in (1, 2, 6)} == {0}
    assert N.near_duplicates(no_docs).count() == 0
    kept = N.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == 8


@pytest.mark.parametrize("most", [1 << 15, 1 << 29])
def test_few_of_loses_none(spark, monkeypatch, most):
    from corvane.llm import common

    monkeypatch.setattr(common, "MOST_BITS", most)
    ids = Scratch(spark).keep(spark.range(0, 90_000, 30).withColumnRenamed("id", "k"))
    rows = spark.range(100_000).select((F.col("id") - 5000).alias("rep"), F.lit("x").alias("_row_of"))
    stay = {r[0] for r in common.few_of(rows, "rep", ids, ids.count()).select("rep").collect()}
    wanted = {k for k in range(0, 90_000, 30)}
    assert wanted <= stay and (len(stay) - len(wanted) < 0.01 * (100_000 - len(wanted))) == (most > 1 << 15)  # a value has 128 bits
    assert common.few_of(rows, "rep", Scratch(spark).keep(ids.limit(0)), 0).count() == 0
