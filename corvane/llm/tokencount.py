"""Token counts by a linear longest-match automaton, without building pieces.

A trie of the vocabulary gets failure links as in linear MaxMatch: where no edge goes on, the
longest piece and what follows it are popped, and matching goes on in the node that the rest of the
text leads to. How many pieces a failure link pops is precomputed, so a segment's greedy
longest-match count takes time linear in its length, however long it is.

Vocabulary: a byte-level file in which every single byte is a piece, so no text is unknown.
Segments: a run of letters, of digits, or of other characters, each with a space before it, or white
space; pieces never cross segments, and segments tile the text. Counts of segments are remembered in
bounded memory. Documents are mapped where they lie: no shuffle.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import LONG, mapped, schema

SEGMENT = re.compile(rb" ?[A-Za-z\x80-\xff]++| ?[0-9]++| ?[^\sA-Za-z0-9\x80-\xff]++|\s(?:(?=[^\s])|\s*+(?<= )(?=[^\s])|\s*+)")
MEMORY_SEGMENTS, MEMORY_BYTES = 500_000, 64


def byte_pieces(path: str) -> list[bytes]:
    """The vocabulary of a byte-level file as bytes. Its printable stand-ins for bytes follow a rule:

    bytes that are printable in Latin-1 stand for themselves, the others in order for 256 and on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    special = {t["content"] for t in made.get("added_tokens", [])}
    return [bytes(byte_of[c] for c in piece) for piece in made["model"]["vocab"] if piece not in special and piece]


class LongestMatch:
    """edges: node * 256 + byte -> node; fail and pops: of each node, -1 where matching cannot go on."""

    def __init__(self, pieces: list[bytes]):
        self.edges: dict[int, int] = {}
        whole, parent, level = [False], [(0, 0)], [0]
        for piece in pieces:
            node = 0
            for b in piece:
                key = node * 256 + b
                if key not in self.edges:
                    self.edges[key] = len(whole)
                    whole.append(False)
                    parent.append((node, b))
                    level.append(level[node] + 1)
                node = self.edges[key]
            whole[node] = True
        self.fail, self.pops = [-1] * len(whole), [0] * len(whole)
        for node in sorted(range(1, len(whole)), key=level.__getitem__):
            if whole[node]:
                self.fail[node], self.pops[node] = 0, 1
                continue
            up, b = parent[node]
            at, popped = self.fail[up], self.pops[up]
            while at >= 0 and at * 256 + b not in self.edges:
                at, popped = self.fail[at], popped + self.pops[at]
            if at >= 0:
                self.fail[node], self.pops[node] = self.edges[at * 256 + b], popped

    def count(self, segment: bytes) -> int:
        """How many pieces greedy longest match takes; -1 if it cannot cover the segment."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node = total = 0
        for b in segment:
            to = edges.get(node * 256 + b)
            while to is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return -1
                to = edges.get(node * 256 + b)
                if to is None and not node:
                    return -1
            node = to
        while node:
            total += pops[node]
            node = fail[node]
            if node < 0:
                return -1
        return total


_loaded: dict[str, LongestMatch] = {}

COUNTS = schema(doc_id=LONG, n_bytes=LONG, n_segments=LONG, n_tokens=LONG)


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_bytes, n_segments, n_tokens of every row of ``docs`` (doc_id, text).

    A null or empty text has 0 of each; texts are read whole; repeated rows are counted alike; a null id
    stays null; an empty table gives an empty result; further columns are ignored. A vocabulary that
    lacks a byte of a text is an error, not a wrong count.
    """

    def work(frames):
        if vocabulary_path not in _loaded:
            _loaded[vocabulary_path] = LongestMatch(byte_pieces(vocabulary_path))
        automaton, known = _loaded[vocabulary_path], {}
        for frame in frames:
            out = []
            for doc, text in zip(frame.column("doc_id").to_pylist(), frame.column("text").to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                segments = SEGMENT.findall(raw)
                total = 0
                for s in segments:
                    n = known.get(s)
                    if n is None:
                        n = automaton.count(s)
                        if n < 0:
                            raise ValueError(f"the vocabulary cannot cover {s[:40]!r}")
                        if len(s) <= MEMORY_BYTES:
                            known[s] = n
                    total += n
                if len(known) > MEMORY_SEGMENTS:
                    known.clear()
                out.append((doc, len(raw), len(segments), total))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 4, names=COUNTS.names)

    return mapped(docs.select("doc_id", "text"), work, COUNTS)
