import zlib
from bisect import bisect_left, insort

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvane.llm import packing as P
from corvane.llm.common import Scratch
from corvane.llm.queries import tokenizer_path
from corvane.llm.tokens import ChunkTokenizer


def best_fit_decreasing(lengths, capacity):
    gaps, bins = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(gaps, n)
        free = gaps.pop(at) if at < len(gaps) else capacity
        bins += free == capacity and at >= len(gaps)
        if free - n:
            insort(gaps, free - n)
    return bins


def positions(plan, counts):
    """Every (sequence, offset, length) of a plan, rank by rank."""
    out, by = [], {}
    for row in plan.tolist():
        by.setdefault(row[0], []).append(row)
    for length, n in counts.items():
        rows = by[length] + [[length, n, 0, 0, 0]]
        for (_, first, each, sequence, offset), (_, end, *_) in zip(rows, rows[1:]):
            out += [(sequence + (r - first) // each, offset + (r - first) % each * length, length) for r in range(first, end)]
    return out


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), min_size=1, max_size=15))
def test_plan_is_gapless_and_as_good_as_best_fit_decreasing(counts):
    plan, opened = P.superstep_plan(counts, 50)
    places = sorted(positions(plan, counts))
    assert len(places) == sum(counts.values())
    ends = {}
    for sequence, offset, length in places:
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert max(ends.values()) <= 50 and len(ends) == opened
    assert opened == best_fit_decreasing([x for x, n in counts.items() for _ in range(n)], 50)


def check(rows, capacity=P.CAPACITY):
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values(), default=0) <= capacity
    return len(ends)


def test_whole_table(few_docs):
    from tokenizers import Tokenizer

    own, want = Tokenizer.from_file(tokenizer_path()), set()
    for d in few_docs.collect():
        ids = own.encode(d["text"], add_special_tokens=False).ids + [1]
        for i, start in enumerate(range(0, len(ids), 4096)):
            cut = ids[start : start + 4096]
            want.add((d["doc_id"], i, start, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    rows = P.pack_documents(few_docs, tokenizer_path()).collect()
    assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)
    assert check(rows) == best_fit_decreasing([r[3] for r in want], 4096)


def test_joined_plan_equals_broadcast_plan(few_docs):
    pieces = Scratch(few_docs.sparkSession).keep(P.token_pieces(few_docs, tokenizer_path()))
    one, two = (sorted(map(tuple, P.place(pieces, broadcast_entries=n).select("doc_id", "piece", "sequence_id", "offset").collect())) for n in (10**6, 0))
    assert one == two


def test_edges(edge_docs, no_docs):
    rows = P.pack_documents(edge_docs, tokenizer_path()).collect()
    check(rows)
    assert [r["length"] for r in rows if r["doc_id"] in (1, 2, 6)] == [1, 1, 1]
    assert sum(r["doc_id"] == 4 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) == 1
    assert P.pack_documents(no_docs, tokenizer_path()).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_give_the_tokenizer_s_ids(name):
    own = ChunkTokenizer(tokenizer_path(name))
    texts = ["It's Α ΑΣ. Σ.x WORLD, I'M <|endoftext|> <|EndOfText|> W̊ foo-bar., İ ÷ a÷b œuf 12ab,, .", "", " \n", "x" * 5000, "É́,a", "straße,. ÿþ Ð", "a\u0085b c\x1cd a b", "ﬁ ﬀx ½ ²", "The end. The END, the", "," * 300 + " x" + "." * 300, "y" * 63 + ". " + "y" * 64 + ", " + "y" * 65 + ".", "é" * 60 + ",", "A <|EndOfText|> B."]
    for text, ids in zip(texts, own.ids(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_small_memory_gives_the_same_ids(few_docs, monkeypatch):
    from corvane.llm import tokens

    texts = [r["text"] for r in few_docs.orderBy("doc_id").collect()]
    own = ChunkTokenizer(tokenizer_path())
    want = own.ids(texts)
    monkeypatch.setattr(tokens, "MEMORY_CHUNKS", 50)
    assert [ids for k in range(0, len(texts), 7) for ids in own.ids(texts[k : k + 7])] == want


def test_hot_length_is_dealt(spark):
    pieces = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("piece"), F.lit(100).cast("long").alias("length"))
    rows = P.place(Scratch(spark).keep(pieces)).collect()
    assert check(rows) == 75 and len(rows) == 3000


def test_many_chunks_are_remembered():
    """Hundreds of thousands of words in between don't make a worker encode the first ones again."""
    own = ChunkTokenizer(tokenizer_path())
    names = ["".join(chr(97 + n // 26**k % 26) for k in range(4)) for n in range(400_000)]
    for at in range(0, len(names), 20_000):
        own.ids([" ".join(names[at : at + 20_000])])
    asked = []
    own._learn_words = asked.extend
    own.ids([" ".join(names[:1000])])
    assert not asked
