import random
import zlib
from collections import Counter

import numpy as np
import pytest

from corvane.llm import onlinepacking as O
from corvane.llm.queries import tokenizer_path
from corvane.llm.tokens import tokenizer


def pieces_of(sizes, capacity, open_windows=O.OPEN_WINDOWS):
    levels, full = O.Levels(capacity, open_windows), []
    for i, s in enumerate(sizes):
        full += levels.add((i, 0, np.arange(s, dtype="<u4").tobytes(), s))
        assert levels.open <= open_windows
    return levels, full


def slow_levels(sizes, capacity):
    """Levels after each size, by trying every level and squaring all counts."""
    count = Counter()
    for s in sizes:
        options = []
        for h in [0, *[h for h in count if count[h] and h + s <= capacity]]:
            after = count.copy()
            if h:
                after[h] -= 1
            if h + s < capacity:
                after[h + s] += 1
            options.append((sum(n * n for n in after.values()), -h, after))
        count = min(options, key=lambda o: o[:2])[2]
    return +count


@pytest.mark.parametrize("seed", range(4))
def test_level_of_the_least_sum_of_squares(seed):
    r = random.Random(seed)
    sizes = [r.choice((3, 5, 7, 11, r.randint(1, 29))) for _ in range(300)]
    levels, _ = pieces_of(sizes, 30)
    want = slow_levels(sizes, 30)
    assert {h: len(w) for h, w in enumerate(levels.windows) if w} == dict(want)
    assert {h: int(levels.squares[h]) for h in range(1, 30) if levels.squares[h]} == dict(want)


@pytest.mark.parametrize("most", [1, 3, 2048])
def test_all_windows_are_full_or_powers_of_two(most):
    r = random.Random(most)
    sizes = [r.choice((60, 60, 60, r.randint(1, 400))) for _ in range(500)]
    levels, full = pieces_of(sizes, 100, most)
    windows = full + list(levels.close())
    lengths = [sum(len(p[2]) // 4 for p in w) for w in windows]
    assert all(n == 100 or n & (n - 1) == 0 for n in lengths) and sum(n != 100 for n in lengths) <= 7
    found = sorted((doc, start, ids) for w in windows for doc, start, ids, _ in w)
    for doc, s in enumerate(sizes):
        assert b"".join(ids for d, _, ids in found if d == doc) == np.arange(s, dtype="<u4").tobytes()
    assert len(found) == len({f[:2] for f in found})


def test_documents_stay_whole_while_windows_may_be_opened():
    sizes = [random.Random(5).randint(1, 99) for _ in range(2000)]
    levels, full = pieces_of(sizes, 100)
    assert all(len(ids) // 4 == total for w in full for _, _, ids, total in w)
    open_before = levels.open
    whole = Counter(doc for w in full + list(levels.close()) for doc, *_ in w)
    assert sum(n > 1 for n in whole.values()) <= open_before + 7


def check(rows, texts, capacity=O.CAPACITY):
    own = tokenizer(tokenizer_path())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    for doc, text in texts:
        ids = own.ids([text or ""])[0] + b"\1\0\0\0"
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids) // 4)
            assert r["ids_crc32"] == zlib.crc32(ids[4 * at : 4 * (at + r["length"])])
            at += r["length"]
        assert 4 * at == len(ids)


def test_every_id_lies_in_one_piece(spark, few_docs):
    rows = O.pack_stream(few_docs.repartition(3), tokenizer_path()).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in few_docs.collect()])
    assert len({r["sequence_id"] >> 40 for r in rows}) == 3


def test_odd_rows(spark, edge_docs, no_docs):
    distinct = edge_docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    check(O.pack_stream(distinct, tokenizer_path()).collect(), [(r["doc_id"], r["text"]) for r in distinct.collect()])
    rows = O.pack_stream(edge_docs, tokenizer_path()).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 4) == 2 * next(r["doc_tokens"] for r in rows if r["doc_id"] == 4)
    assert any(r["doc_id"] is None for r in rows)
    assert O.pack_stream(no_docs, tokenizer_path()).columns == O.OUT.names and O.pack_stream(no_docs, tokenizer_path()).count() == 0
