"""Benchmark decontamination by one Aho-Corasick automaton over normalised test items.

A window is ``window`` consecutive words of an item; an item of fewer words is one window. The items
are stored once, as numbers of words. The automaton's patterns are anchors in them: runs of half a
window, chosen so close that every window holds a whole one (a short item is an anchor by itself). Each
normalised document is scanned once, word by word. From an anchor that is met, the match is extended
word by word to both sides in its item; all windows inside the match are hits. Hits are intervals of
word numbers and, through those, offsets in the original text.

Scale. Documents are mapped where they lie, without a shuffle. The automaton has fewer nodes than the
items have words (patterns of whole windows would take ten times as many, of characters seventy). It is
built once, on the driver, and broadcast as arrays for at most BLOCK_WORDS words, some 6 MB of items. Its
edges are hashed, and a filter of word pairs stands before it, so the time a word takes doesn't grow with
the benchmark. Larger benchmarks are scanned in several blocks: then the documents are written once with a
number, and each block gives the hits by number only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LONG, Scratch, mapped, schema
from .words import merged, normalised, original_spans, word_count

WINDOW = 10
BLOCK_WORDS = 1_000_000  # of items in one automaton, some 100 MB in a worker


def _pairs(*names: str) -> T.ArrayType:
    return T.ArrayType(schema(**{n: LONG for n in names}))


_HITS = schema(n_words=LONG, hits=_pairs("first", "end"), spans=_pairs("start", "end"), items=T.ArrayType(LONG))


def anchors(often: list[int], spread: int) -> list[int]:
    """Starts such that any ``spread`` starts in a row hold one: the rarest of the next ones, of ties the last.

    ``often`` tells for each possible start how often what stands there does so in the items, so a phrase that
    many items share is no anchor while there is a rarer one.
    """
    out, at = [], -1
    while at + spread < len(often):
        at = min(range(at + spread, at, -1), key=often.__getitem__)
        out.append(at)
    return out


class Automaton(NamedTuple):
    """Aho-Corasick over word numbers as arrays; state 0 is the root, and states are numbered by depth."""

    keys: np.ndarray  # state * words + word of each edge, ascending
    targets: np.ndarray
    fail: np.ndarray  # the state of the longest proper suffix of at least two words that is one, else 0
    anchor: np.ndarray  # what ends in a state: an anchor's number, or -1
    shorter: np.ndarray  # the next state along the failure links in which an anchor ends, or 0
    lengths: np.ndarray  # of the anchors
    first_place: np.ndarray  # anchor -> where its places begin in ``places``; one more at the end
    places: np.ndarray  # (place in the items' words, item)


def build(anchors_at: dict[tuple[int, ...], list[tuple[int, int]]], words: int) -> Automaton:
    """The automaton of anchors (word numbers below ``words``), each with its places."""
    edges: dict[int, int] = {}
    parent, letter, depth, ends = [0], [0], [0], {}
    for number, anchor in enumerate(anchors_at):
        state = 0
        for d, word in enumerate(anchor, 1):
            key = state * words + word
            state = edges.get(key, -1)
            if state < 0:
                state = edges[key] = len(parent)
                parent.append(key // words)
                letter.append(word)
                depth.append(d)
        ends[state] = number
    fail, anchor_of, shorter = [0] * len(parent), [-1] * len(parent), [0] * len(parent)
    for state in sorted(range(len(parent)), key=depth.__getitem__):
        if depth[state] > 1:
            link, word = fail[parent[state]], letter[state]
            while link and (to := edges.get(link * words + word)) is None:
                link = fail[link]
            fail[state] = to if link else edges.get(word, 0)
        anchor_of[state] = ends.get(state, -1)
        link = fail[state]
        shorter[state] = link if anchor_of[link] >= 0 else shorter[link]
    single = np.array(depth) == 1  # anchors of one word are told by the word, so links end before them
    fail, shorter = np.array(fail, np.int32), np.array(shorter, np.int32)
    fail[single[fail]] = 0
    shorter[single[shorter]] = 0
    keys, targets = np.fromiter(edges, np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges))
    order = np.argsort(keys)
    places = np.array([p for found in anchors_at.values() for p in found], np.int64).reshape(-1, 2)
    first = np.cumsum([0, *map(len, anchors_at.values())])
    return Automaton(keys[order], targets[order], fail, np.array(anchor_of, np.int32), shorter, np.array([*map(len, anchors_at)], np.int32), first, places)


class Block:
    """Items as word numbers one after the other, each with its id, and their automaton, built once on the driver."""

    def __init__(self, items: Sequence[tuple[int | None, list[str]]], window: int):
        self.key, self.window, self.numbers, self.length = uuid.uuid4().hex, window, {}, (window + 1) // 2
        self.ids = [i for i, _ in items]
        self.starts = np.cumsum([0, *(len(w) for _, w in items)])
        self.words = np.fromiter((self.numbers.setdefault(w, len(self.numbers)) for _, words in items for w in words), np.int32, int(self.starts[-1]))
        self.automaton = build(self._anchors(), len(self.numbers) + 1)  # one number more: any other word

    def _often(self) -> list[int]:
        """How often the pair of words at each place stands in the items (by a hash): what texts have often begins no anchor."""
        length = min(2, self.length)
        n = max(0, len(self.words) - length + 1)
        mixed = np.zeros(n, np.uint64)
        for i in range(length):
            mixed = (mixed ^ self.words[i : i + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        _, which, counts = np.unique(mixed, return_inverse=True, return_counts=True)
        return counts[which].tolist()

    def _anchors(self) -> dict[tuple[int, ...], list[tuple[int, int]]]:
        """Anchor -> the places in ``words`` where it stands, with the item of each."""
        places, often = {}, self._often()
        for item, (a, b) in enumerate(zip(self.starts.tolist(), self.starts[1:].tolist())):
            own = tuple(self.words[a:b].tolist())
            if b - a <= self.window:
                places.setdefault(own, []).append((a, item))
                continue
            for at in anchors(often[a : b - self.length + 1], self.window - self.length + 1):
                places.setdefault(own[at : at + self.length], []).append((a + at, item))
        return places


_MIX = np.uint64(0x9E3779B97F4A7C15)


class Matcher:
    """What a worker makes of a block: its edges as a dictionary, and a filter of the pairs of words that lead to depth two.

    A text's words are numbered and all neighbouring pairs looked up in the filter at once; the automaton runs
    from the pairs that pass, along its failure links, until it falls below depth two. So most words cost two
    lookups in arrays, whatever the number of edges, and only what begins like an anchor costs a step each.
    """

    def __init__(self, block: Block):
        self.block, made = block, block.automaton
        self.words, self.starts, self.many = block.words.tolist(), block.starts.tolist(), len(block.numbers) + 1
        self.edges = dict(zip(made.keys.tolist(), made.targets.tolist()))
        self.fail, self.anchor, self.shorter, self.lengths = (x.tolist() for x in (made.fail, made.anchor, made.shorter, made.lengths))
        from_root = made.keys < self.many
        second = np.isin(made.keys // self.many, made.targets[from_root])
        first_word = np.zeros(len(made.fail), np.int64)
        first_word[made.targets[from_root]] = made.keys[from_root]
        pairs = first_word[made.keys[second] // self.many], made.keys[second] % self.many
        self.shift = np.uint64(64 - max(16, min(28, int(64 * len(pairs[0]) + 1).bit_length())))
        self.may = np.zeros(1 << 64 - int(self.shift), bool)
        self.may[self._slot(*pairs)] = True
        self.single = np.zeros(self.many, bool)
        self.single[made.keys[from_root][made.anchor[made.targets[from_root]] >= 0]] = True
        self.any_single = bool(self.single.any())

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a.astype(np.uint64) * _MIX) ^ (b.astype(np.uint64) + (b.astype(np.uint64) << np.uint64(32)))) * _MIX >> self.shift

    def _anchors_in(self, text: np.ndarray) -> Iterator[tuple[int, int]]:
        """(last word, anchor) of each anchor that stands in the text."""
        if self.any_single:
            for at in np.flatnonzero(self.single[text]).tolist():
                yield at, self.anchor[self.edges[int(text[at])]]
        candidates = np.flatnonzero(self.may[self._slot(text[:-1], text[1:])]).tolist()
        if not candidates:
            return
        words, edges, fail, many, n, free = text.tolist(), self.edges, self.fail, self.many, len(text), 0
        for at in candidates:
            if at < free:
                continue
            state = edges.get(edges.get(words[at], -1) * many + words[at + 1])
            if state is None:
                continue
            at += 1
            while True:
                found = state if self.anchor[state] >= 0 else self.shorter[state]
                while found:
                    yield at, self.anchor[found]
                    found = self.shorter[found]
                at += 1
                if at == n:
                    break
                word = words[at]
                while state and (to := edges.get(state * many + word)) is None:
                    state = fail[state]
                if not state:
                    break
                state = to
            free = at - 1  # the last word that fitted may begin a pair with the one that didn't

    def find(self, norm: str) -> tuple[list[tuple[int, int]], set[int | None]]:
        """Word intervals [first, end) of a normalised text that lie in windows, and the ids of the items."""
        if not norm or not self.edges:
            return [], set()
        number, unknown = self.block.numbers.get, self.many - 1
        text = np.array([number(w, unknown) for w in norm.split()], np.int64)
        words, starts, window, intervals, items = self.words, self.starts, self.block.window, set(), set()
        places, first_place = self.block.automaton.places, self.block.automaton.first_place
        done: dict[tuple[int, int], int] = {}  # (item, place in it less place in the text) -> end of the last match there
        for last, anchor in self._anchors_in(text):
            length = self.lengths[anchor]
            first, end = last - length + 1, last + 1
            for at, item in places[first_place[anchor] : first_place[anchor + 1]].tolist():
                diagonal = (item, at - first)
                if done.get(diagonal, -1) >= end:
                    continue
                low, high = starts[item], starts[item + 1]
                a, i = first, at
                while a > 0 and i > low and text[a - 1] == words[i - 1]:
                    a, i = a - 1, i - 1
                b, j = end, at + length
                while b < len(text) and j < high and text[b] == words[j]:
                    b, j = b + 1, j + 1
                done[diagonal] = b
                if b - a >= min(window, high - low):
                    intervals.add((a, b))
                    items.add(self.block.ids[item])
        return merged(intervals), items


def in_order(items: set[int | None]) -> list[int | None]:
    """Ascending; the null id, which stands for all items without an id, comes last."""
    return sorted(items, key=lambda i: (i is None, i or 0))


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items in blocks of bounded size; they come one by one from the executors. A single longer item is a block."""
    held, words = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        own = normalised(row["text"]).split()
        if held and words + len(own) > block_words:
            yield Block(held, window)
            held, words = [], 0
        if own:
            held.append((row["item_id"], own))
            words += len(own)
    if held:
        yield Block(held, window)


_built: dict[str, Matcher] = {}


def _matcher(shared) -> Matcher:
    """The worker's automaton of this broadcast block; an older one makes way."""
    block = shared.value
    if block.key not in _built:
        _built.clear()
        _built[block.key] = Matcher(block)
    return _built[block.key]


def _spans(text: str, hits: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Code points of the intervals' words in the original text."""
    ends = iter(original_spans(text, [w for a, b in hits for w in ((a, b - 1) if b - a > 1 else (a,))]))
    out = []
    for a, b in hits:
        start, stop = next(ends)
        out.append({"start": start, "end": next(ends)[1] if b - a > 1 else stop})
    return out


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, with_spans: bool = True, column: str = "leak") -> DataFrame:
    """``docs`` with a struct ``column``: n_words, hits (word intervals), spans (code points), items.

    A null or empty text has no words; texts are read whole; repeated rows are judged alike; an empty
    benchmark hits nothing; an empty table gives an empty result. Items with a null id hit as others do
    and stand in ``items`` as one null, the last; repeated items count once. A column of that name in the
    input is replaced, the others stay.
    """
    spark, docs = docs.sparkSession, docs.drop(column)
    made = blocks(benchmark, window, block_words)
    first, second = next(made, Block([], window)), next(made, None)
    if second is None:
        return _with_leak(docs, spark.sparkContext.broadcast(first), with_spans, column)
    scratch, number = Scratch(spark), max(docs.columns, key=len) + "_number"  # no column has this name
    numbered = scratch.keep(docs.withColumn(number, F.monotonically_increasing_id()))  # written, so the numbers stay
    found = None
    for block in (first, second, *made):
        part = scratch.keep(_hits_by_number(numbered.select(F.col(number).alias("number"), "text"), spark.sparkContext.broadcast(block)))
        found = part if found is None else found.unionAll(part)
    known = found.groupBy("number").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))  # a row a block at most
    both = known.select(F.col("number").alias(number), F.struct(F.lit(0).cast("long").alias("n_words"), "hits", F.lit(None).cast(_pairs("start", "end")).alias("spans"), "items").alias(column))
    return _collected(numbered.join(both, number, "left").select(*docs.columns, column), with_spans, column)


def _described(text: str | None, norm: str, hits: list[tuple[int, int]], items: set, with_spans: bool) -> dict:
    return {"n_words": word_count(norm), "hits": [{"first": a, "end": b} for a, b in hits], "spans": _spans(text, hits) if hits and with_spans else [], "items": in_order(items)}


def _with_leak(docs: DataFrame, shared, with_spans: bool, column: str) -> DataFrame:
    out = T.StructType([*docs.schema.fields, T.StructField(column, _HITS)])
    kind = _arrow(_HITS)

    def work(frames):
        matcher = _matcher(shared)
        for frame in frames:
            rows = []
            for text in frame.column("text").to_pylist():
                norm = normalised(text)
                rows.append(_described(text, norm, *matcher.find(norm), with_spans))
            yield pa.RecordBatch.from_arrays([*frame.columns, pa.array(rows, kind)], names=out.names)

    return mapped(docs, work, out)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _hits_by_number(texts: DataFrame, shared) -> DataFrame:
    """number, hits, items of the texts that have hits."""
    out = schema(number=LONG, hits=_pairs("first", "end"), items=T.ArrayType(LONG))
    kinds = [_arrow(f.dataType) for f in out]

    def work(frames):
        matcher = _matcher(shared)
        for frame in frames:
            rows = [(n, [{"first": a, "end": b} for a, b in hits], in_order(items)) for n, text in zip(frame.column("number").to_pylist(), frame.column("text").to_pylist()) for hits, items in [matcher.find(normalised(text))] if hits]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*rows) if rows else ((), (), ()), kinds)], names=out.names)

    return mapped(texts, work, out)


def _collected(docs: DataFrame, with_spans: bool, column: str) -> DataFrame:
    """The same column from the hits and items of several blocks."""
    kind, names = _arrow(_HITS), docs.columns

    def work(frames):
        for frame in frames:
            rows = []
            for text, before in zip(frame.column("text").to_pylist(), frame.column(column).to_pylist()):
                hits = merged([(h["first"], h["end"]) for h in before["hits"]] if before else [])
                rows.append(_described(text, normalised(text), hits, {*before["items"]} if before else set(), with_spans))
            at = frame.schema.get_field_index(column)
            yield pa.RecordBatch.from_arrays([*frame.columns[:at], pa.array(rows, kind), *frame.columns[at + 1 :]], names=names)

    return mapped(docs, work, docs.schema)


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs`` (doc_id, text).

    A null or empty text has no words and no hits; texts of any length are read whole; repeated rows are
    judged alike; a null id stays null; an empty table gives an empty result; further columns are
    ignored. Items with a null id together count as one in n_items and are left out of items_sha256.
    """
    found = scan(docs.select("doc_id", "text"), benchmark, window, with_spans=False)
    hits = F.aggregate("leak.hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["first"])
    items = F.array_sort(F.transform("leak.items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        F.col("leak.n_words").alias("n_words"),
        hits.alias("n_hit"),
        F.size("leak.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with all their columns, whatever their names.

    Rows with a null or empty text stay, repeated rows share their fate, a null id is nothing special,
    and an empty benchmark or table takes nothing away.
    """
    free = max(docs.columns, key=len) + "_leak"  # no column has this name
    return scan(docs, benchmark, window, with_spans=False, column=free).where(F.size(F.col(free)["hits"]) == 0).select(*docs.columns)
