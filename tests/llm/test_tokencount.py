import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corvane.llm import tokencount as C
from corvane.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def greedy(text, pieces):
    most, at, n = max(map(len, pieces)), 0, 0
    while at < len(text):
        size = next((k for k in range(min(most, len(text) - at), 0, -1) if text[at : at + k] in pieces), 0)
        if not size:
            return -1
        at, n = at + size, n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + c % 3 for c in b)), min_size=1, max_size=12), st.binary(max_size=25).map(lambda b: bytes(97 + c % 3 for c in b)))
def test_any_vocabulary(pieces, text):
    assert C.LongestMatch(sorted(pieces)).count(text) == greedy(text, pieces)


@pytest.fixture(scope="module")
def automaton():
    return C.LongestMatch(C.byte_pieces(PATH))


def test_long_segment_is_linear(automaton):
    assert automaton.count(b"a" * 400_000) > 0


def test_segments_tile_the_text():
    for text in ("", "a  b\n\n c\t\td", "日本語 text  ", "  lead", " \u00a0x", "\r\n\r\n", "a\n b"):
        assert b"".join(C.SEGMENT.findall(text.encode())) == text.encode()


def test_whole_table(few_docs, automaton):
    pieces, known = set(C.byte_pieces(PATH)), {}
    rows = {r["doc_id"]: r for r in C.count_tokens(few_docs, PATH).collect()}
    for d in few_docs.collect():
        raw, total = d["text"].encode(), 0
        for s in C.SEGMENT.findall(raw):
            if s not in known:
                known[s] = greedy(s, pieces)
            total += known[s]
        assert rows[d["doc_id"]]["n_tokens"] == total and rows[d["doc_id"]]["n_bytes"] == len(raw)


def test_edges(edge_docs, no_docs):
    rows = C.count_tokens(edge_docs, PATH).collect()
    assert len(rows) == 9 and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert C.count_tokens(no_docs, PATH).count() == 0
