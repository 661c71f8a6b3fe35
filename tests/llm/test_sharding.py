import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvane.llm import sharding as S


def naive(sizes, capacity):
    bins, out = [], []
    for s in sizes:
        fits = [(free, i) for i, free in enumerate(bins) if free >= s]
        if not fits:
            bins.append(capacity)
            fits = [(capacity, len(bins) - 1)]
        _, i = min(fits)
        bins[i] -= s
        out.append(i)
    return out


def runs_of(sizes):
    return sorted(Counter(sizes).items(), reverse=True)


def shards_of(plan, runs):
    """Size -> the shard of each rank."""
    out = {}
    for size, n in runs:
        own = sorted(p[1:] for p in plan if p[0] == size) + [(n, 1, 0)]
        out[size] = [first + (r - rank) // each for (rank, each, first), (end, *_) in zip(own, own[1:]) for r in range(rank, end)]
        assert len(out[size]) == n and own[0][0] == 0
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 70), min_size=1, max_size=60))
def test_runs_pack_as_groups_one_by_one(sizes):
    runs = runs_of(sizes)
    plan, opened = S.packed(runs, 60)
    held = defaultdict(list)
    for size, shards in shards_of(plan, runs).items():
        for shard in shards:
            held[shard].append(size)
    assert set(held) == set(range(opened)) and all(sum(h) <= 60 or len(h) == 1 for h in held.values())
    large = [s for s in sizes if s > 60]
    assert opened == len(large) + len(set(naive(sorted((s for s in sizes if s <= 60), reverse=True), 60)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 500), min_size=1, max_size=80), st.integers(1, 9))
def test_smallest_capacity_uses_every_rank_once(sizes, shards):
    runs = runs_of(sizes)
    plan, opened = S.smallest_capacity(runs, shards)
    assert opened <= shards and sum(map(len, shards_of(plan, runs).values())) == len(sizes)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=80))
def test_tree_takes_the_tightest(keys):
    tree, held = S.CapacityTree(), []
    for i, k in enumerate(keys):
        tree.insert((k, i))
        held.append((k, i))
        if i % 3 == 2:
            want = min([h for h in held if h[0] >= k - 1], default=None)
            assert tree.take_tightest(k - 1) == want
            held.remove(want)


def test_whole_table(few_docs):
    rows = S.shard_documents(few_docs, 8).collect()
    texts = {d["doc_id"]: d["text"] for d in few_docs.collect()}
    shards, slots, of_text = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw)
        shards[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        of_text[texts[r["doc_id"]]].add(r["shard"])
    assert len(rows) == len(texts) and set(shards) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in of_text.values())
    assert max(shards.values()) <= 1.02 * min(shards.values())


def test_a_hot_group_has_a_shard_alone(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 300, "same text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    rows = S.shard_documents(docs, 10).collect()
    hot = {r["shard"] for r in rows if r["doc_id"] < 300}
    assert len(hot) == 1 and not any(r["shard"] in hot for r in rows if r["doc_id"] >= 300)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["shard"]] += r["size"]
    rest = [v for k, v in sizes.items() if k not in hot]
    assert len(rest) == 9 and max(rest) <= 1.05 * min(rest)


def test_rounded_up(spark):
    sizes = [16, 8191, 8192, 8193, 16_383, 16_385, 100_000, 10**12 + 1]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in sizes], "s long").select(S.rounded_up(F.col("s"))).collect()]
    want = [-(-s // 2 ** max(0, s.bit_length() - 13)) * 2 ** max(0, s.bit_length() - 13) for s in sizes]
    assert got == want and all(s <= g <= s * (1 + 2**-12) for s, g in zip(sizes, got))


def test_many_small_shards_never_exceed_their_capacity(spark):
    """As many shards as a third of the groups, and one group that is larger than a shard."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    copies = docs.where("doc_id < 3").crossJoin(spark.range(300)).select("doc_id", "text")
    rows = S.shard_documents(docs.select("doc_id", "text").unionAll(copies), capacity=8_000).collect()
    sizes, groups, of_group, bytes_of = Counter(), defaultdict(set), defaultdict(set), Counter()
    for r in rows:
        key = (r["text_crc32"], r["size"])
        sizes[r["shard"]] += r["size"]
        groups[r["shard"]].add(key)
        of_group[key].add(r["shard"])
        bytes_of[key] += r["size"]
    assert len(rows) == docs.count() + copies.count() and all(len(v) == 1 for v in of_group.values())
    assert all(v <= 8_000 or len(groups[k]) == 1 for k, v in sizes.items()) and any(v > 8_000 for v in sizes.values())
    small = sorted((v for v in bytes_of.values() if v <= 8_000), reverse=True)
    assert len(sizes) == len(set(naive(small, 8_000))) + sum(v > 8_000 for v in bytes_of.values())


def test_fixed_capacity(spark, few_docs):
    total = few_docs.agg(F.sum(F.octet_length("text") + S.ROW_BYTES)).first()[0]
    rows = S.shard_documents(few_docs, capacity=60_000).collect()
    sizes, texts = defaultdict(int), defaultdict(set)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        texts[r["text_crc32"]].add(r["shard"])
    assert all(v <= 60_000 or sum(r["shard"] == k for r in rows) == 1 for k, v in sizes.items())
    assert len(sizes) <= -(-total // 60_000) + 1 and all(len(v) == 1 for v in texts.values())


def test_edges(edge_docs, no_docs):
    rows = S.shard_documents(edge_docs, 4).collect()
    assert len(rows) == 9 and {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {16}
    assert len({r["shard"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert S.shard_documents(no_docs, 4).count() == 0
