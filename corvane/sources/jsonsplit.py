"""Large JSON documents, read in parallel splits: the elements of an array, or of the containers of an object.

The text reader cuts a document at its closing braces, so a split is a run of fragments, wherever lines end.
A split doesn't know whether it begins inside a string, nor how deep. One pass therefore computes, for both
possible beginnings, how a split ends and how many elements begin at each depth relative to its start. These
rows, one a split (some 128 MB), are composed in a prefix scan, which gives every split its true beginning.
A second pass cuts each split's own elements; one that spans splits comes in pieces, and only these are
brought together. No task holds more than a fragment and the element at hand.

A closing brace inside a name that leads a container hides that name. A damaged document gives the elements
as they can be told apart.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import mapped

_ESCAPED = re.compile(r"\\.", re.S)
_MARKS = re.compile(r"[\[\]{},]")
_TOKEN = re.compile(r'"(?:[^"\\]++|\\.)*+("?)|[\[\]{},]', re.S)
_STRING_REST = re.compile(r'(?:[^"\\]++|\\.)*+("?)', re.S)


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """file, start (of the split), value: the text between closing braces, in the document's order within a split."""
    raw = spark.read.option("lineSep", "}").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _by_split(frames) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """The fragments of each split, one split after the other."""
    from itertools import groupby

    rows = (row for frame in frames for row in zip(*(frame.column(i).to_pylist() for i in range(3))))
    for key, own in groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2] for r in own)


_ENDS = "file string, start bigint, flips boolean, deltas array<int>, opens array<map<int,bigint>>, commas array<map<int,bigint>>"


def _ends(frames) -> Iterator[pa.RecordBatch]:
    """Of each split: whether it turns inside into outside of strings; and for a start outside (0) and inside (1) its change of depth, and containers and commas by relative depth."""
    for (file, start), texts in _by_split(frames):
        inside, depth, opens, commas = False, [0, 0], (Counter(), Counter()), (Counter(), Counter())
        for text in texts:
            parts = (_ESCAPED.sub("", text) if "\\" in text else text).split('"')
            for h in (0, 1):
                d = depth[h]
                for mark in _MARKS.findall(" ".join(parts[inside ^ h :: 2])):
                    if mark == ",":
                        commas[h][d] += 1
                    elif mark in "[{":
                        d += 1
                        opens[h][d] += 1
                    else:
                        d -= 1
                depth[h] = d
            inside ^= len(parts) % 2 == 0
            depth[inside] -= 1  # the brace after the fragment is outside of strings for the one of both that is
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), *[pa.list_(pa.map_(pa.int32(), pa.int64()))] * 2]
        values = [file, start, bool(inside), depth, [list(c.items()) for c in opens], [list(c.items()) for c in commas]]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["file", "start", "flips", "deltas", "opens", "commas"])


def beginnings(pieces: DataFrame, level: int) -> DataFrame:
    """file, start, inside, depth, containers, commas of each split: its true state, and what began at ``level`` before it."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    states = mapped(pieces, _ends, _ENDS).withColumn("inside", (so_far(F.col("flips").cast("int")) % 2).cast("int"))
    deep = states.withColumn("depth", so_far(F.get("deltas", "inside")))
    here = [F.coalesce(F.try_element_at(F.get(c, "inside"), (level - F.col("depth")).cast("int")), F.lit(0)) for c in ("opens", "commas")]
    return deep.select("file", "start", (F.col("inside") == 1).alias("inside"), "depth", so_far(here[0]).alias("containers"), so_far(here[1]).alias("commas"))


_CUT = "file string, container bigint, name string, index bigint, start bigint, whole boolean, value string"


def _cut(known: dict, level: int, names_only: bool, files: set[str] | None = None):
    """Maps fragments to elements, or pieces of them; with ``names_only`` to the containers' names (whole) and last indices (not whole).

    ``files`` are those that are cut, by default all.
    """

    def split(key: tuple[str, int], texts: Iterator[str]):
        if key not in known:
            raise ValueError(f"{key}: the splits are others than at the first pass; read the document again")
        inside, depth, containers, commas = known[key]
        index, name, held, begun = containers + commas - 1, None, [], False
        for text in texts:
            text += "}"
            pos, mark, last, opened = 0, 0, None, None  # of the element at hand, what lies before ``mark`` is done
            if inside:
                found = _STRING_REST.match(text)
                pos, inside = found.end(), not found[1]
            for m in _TOKEN.finditer(text, pos):
                c = text[m.start()]
                if c == '"':
                    inside = not m[1]
                    if depth == level - 1:
                        last = m
                    continue
                if c in "[{":
                    depth += 1
                    if depth == level:
                        containers, index, begun, mark, opened, held = containers + 1, index + 1, True, m.end(), m.end(), []
                        name = _name(last)
                        if names_only and name is not None:
                            yield containers - 1, name, index, True, ""
                    continue
                if depth == level and not names_only:
                    held.append(text[mark : m.start()])
                    yield containers - 1, name, index, begun, "".join(held)
                    held, begun = [], True
                if c == ",":
                    if depth == level:
                        index, mark = index + 1, m.end()
                else:
                    if depth == level and names_only:
                        empty = opened is not None and not text[opened : m.start()].strip()
                        yield containers - 1, None, index - empty, False, ""
                    depth -= 1
            if depth >= level and not names_only:
                held.append(text[mark:])
        if depth >= level and not names_only:
            yield containers - 1, name, index, False, "".join(held)  # goes on in the next split, or never ends

    def _name(m) -> str | None:
        try:
            return json.loads(m[0]) if m else None
        except ValueError:
            return None

    def work(frames):
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        names = ["file", "container", "name", "index", "start", "whole", "value"]
        held, size = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held), kinds)], names=names)

        for (file, start), texts in _by_split(frames):
            if files is not None and file not in files:
                continue
            for container, name, index, whole, value in split((file, start), texts):
                held.append((file, container, name, index, start, whole, value))
                size += len(value)
                if len(held) >= 1000 or size > 4 << 20:
                    yield batch()
                    held, size = [], 0
        if held:
            yield batch()

    return work


def top_level(spark: SparkSession, path: str) -> str:
    """The first character of a document that is no white space; empty if there is none. Reads one fragment."""
    head = fragments(spark, path).select("value").limit(1).collect()
    return head[0][0].lstrip("\ufeff \t\r\n")[:1] if head else ""


class Document:
    """The elements at ``level`` of the documents of ``path``: 1 for those of an array, 2 for those of an object's containers.

    The first pass runs at once, and leaves a row a split on the driver: 1 MB for 2 TB.
    """

    def __init__(self, spark: SparkSession, path: str, level: int = 1):
        self.pieces, self.level = fragments(spark, path), level
        self.known = {(r["file"], r["start"]): (r["inside"], r["depth"], r["containers"], r["commas"]) for r in beginnings(self.pieces, level).collect()}

    def elements(self, files: set[str] | None = None) -> DataFrame:
        """file, container, index, value: the text of each element, numbered over its document; empty ones are left out. Of all files or of some."""
        cut = mapped(self.pieces, _cut(self.known, self.level, False, files), _CUT)
        together = cut.where(~F.col("whole")).groupBy("file", "container", "index").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "value"))), lambda p: p["value"]), "").alias("value"))
        both = cut.where("whole").select("file", "container", "index", "value").unionByName(together)
        return both.withColumn("value", F.btrim("value", F.lit(" \t\r\n"))).where("value <> ''")

    def names(self) -> DataFrame:
        """file, container, name of the containers of an object."""
        return mapped(self.pieces, _cut(self.known, self.level, True), _CUT).where("whole").select("file", "container", "name")

    def spans(self) -> DataFrame:
        """file, container, name, first, last: containers of an object with the indices of their elements; an empty one ends before it begins."""
        marks = mapped(self.pieces, _cut(self.known, self.level, True), _CUT).groupBy("file", "container")
        found = marks.agg(F.max("name").alias("name"), F.max(F.when(F.col("whole"), F.col("index"))).alias("first"), F.max(F.when(~F.col("whole"), F.col("index"))).alias("last"))
        return found.where("name is not null")
