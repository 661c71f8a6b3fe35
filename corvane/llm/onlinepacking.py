"""Sum-of-squares online packing of tokenised documents into windows of fixed length.

Windows that are neither empty nor full are counted by how full they are in a level array: N[h] windows
hold h tokens. A document of s tokens goes whole into the level h (or into a new window) for which the
sum of all N[h]^2 afterwards is least: h loses a window, h + s gains one, and a window that becomes full
is counted no more. So no level is left with many windows that nothing fits, whatever the sizes are. Of
equal sums the fullest level is taken. A longer document first fills whole windows; its rest is placed so.

Cuts. A document is cut in three cases only: it is longer than a window; ``open_windows`` windows are open
already and it fits into none, so that it fills one of them (again by the least sum of squares) and goes on
with the rest; or the stream ends. Then the pieces of the emptiest windows, cut where they must be, fill
the fullest ones, and the one window that is left over is stored as its powers of two, which need no
padding. So no token of padding is left at all; what the method decides is how many documents stay whole.

Scale. Each partition of the input is one stream with a level array of its own: no shuffle, no key that
could be hot, and nothing is collected. A task holds the ids of its open windows, ``open_windows`` times
``capacity`` tokens at most (16 MB), besides the batch at hand; a placed piece leaves it when its window
is full. Windows are numbered by partition, and the rows are written once, so a task that is run again
changes nothing that was read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import LONG, Scratch, mapped, schema
from .tokens import batches, tokenizer

CAPACITY, END_ID = 2048, 1
OPEN_WINDOWS = 2048  # that a task keeps open: 16 MB of ids
_EMPTY, _NEVER = 0.5, -1e18  # what stands in the level array for a new window, and for a level without windows

Piece = tuple[int | None, int, bytes, int]  # document, start in it, little-endian 32-bit ids, tokens of the document
OUT = schema(doc_id=LONG, start=LONG, length=LONG, ids_crc32=LONG, doc_tokens=LONG, sequence_id=LONG, offset=LONG)


class Levels:
    """The level array, and the windows behind it; ``add`` yields the windows that become full."""

    def __init__(self, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS):
        self.capacity, self.most, self.open = capacity, open_windows, 0
        self.squares = np.zeros(capacity + 1)  # N[h]; a full window counts nothing, so the last entry turns its gain into none
        self.squares[0], self.squares[capacity] = _EMPTY, -0.5
        self.takes = np.full(capacity + 1, _NEVER)  # N[h] where there is a window to take, and the new window
        self.takes[0] = _EMPTY
        self.windows: list[list[list[Piece]]] = [[] for _ in range(capacity)]

    def _count(self, level: int, change: int) -> None:
        if 0 < level < self.capacity:
            self.open += change
            self.squares[level] += change
            self.takes[level] = self.squares[level] if self.squares[level] else _NEVER

    def whole(self, size: int) -> int:
        """The level in which a document of ``size`` tokens makes the sum of squares least; -1 if it fits no open window and none may be opened."""
        least = self.squares[size:] - self.takes[: self.capacity + 1 - size]
        if self.open >= self.most:
            least[0] = -_NEVER
        at = len(least) - 1 - int(np.argmin(least[::-1]))
        return at if least[at] < -_NEVER / 2 else -1

    def cut(self, size: int) -> int:
        """The level whose windows are filled by a part of the document, the rest being placed at the level that it makes."""
        low = self.capacity + 1 - size
        least = self.squares[1:size] - self.takes[low : self.capacity]
        return low + len(least) - 1 - int(np.argmin(least[::-1]))

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        doc, start, ids, total = piece
        while ids:
            size = len(ids) // 4
            if size >= self.capacity:
                level, size = 0, self.capacity
            elif (level := self.whole(size)) < 0:
                level = self.cut(size)
                size = self.capacity - level
            window = self.windows[level].pop() if level else []
            window.append((doc, start, ids[: 4 * size], total))
            self._count(level, -1)
            self._count(level + size, 1)
            if level + size == self.capacity:
                yield window
            else:
                self.windows[level + size].append(window)
            start, ids = start + size, ids[4 * size :]

    def close(self) -> Iterator[list[Piece]]:
        """The windows at the end: the emptiest are emptied into the fullest; what is left over comes in powers of two."""
        rest = [(level, window) for level, windows in enumerate(self.windows) for window in windows]  # emptiest first
        self.__init__(self.capacity, self.most)
        source: list[Piece] = []
        while rest or source:
            level, window = rest.pop() if rest else (0, [])
            while level < self.capacity and (source or rest):
                if not source:
                    source = rest.pop(0)[1]
                doc, start, ids, total = source.pop()
                part = 4 * (self.capacity - level)
                window.append((doc, start, ids[:part], total))
                level += len(window[-1][2]) // 4
                if len(ids) > part:
                    source.append((doc, start + part // 4, ids[part:], total))
            yield from [window] if level == self.capacity else _powers_of_two(window)


def _powers_of_two(window: list[Piece]) -> Iterator[list[Piece]]:
    left = sum(len(ids) for _, _, ids, _ in window) // 4
    pieces = window[::-1]
    while left:
        size = 1 << left.bit_length() - 1
        left, out = left - size, []
        while size:
            doc, start, ids, total = pieces.pop()
            out.append((doc, start, ids[: 4 * size], total))
            if len(ids) > 4 * size:
                pieces.append((doc, start + size, ids[4 * size :], total))
            size -= len(out[-1][2]) // 4
        yield out


def pack_stream(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row a piece of every document.

    A window's tokens number ``capacity`` or a power of two. A null or empty text is the end id alone; a
    very long one fills whole windows and one place more; equal texts and repeated rows, also those without
    an id, each get places of their own; equal sums of squares are decided for the fullest level; an empty
    table gives an empty result; columns besides doc_id and text are ignored.
    """
    end = np.array([end_id], "<u4").tobytes()

    def pack(frames):
        from pyspark import TaskContext

        own, levels, number = tokenizer(tokenizer_path), Levels(capacity, open_windows), TaskContext.get().partitionId() << 40

        def rows(windows):
            nonlocal number
            for window in windows:
                offset = 0
                for doc, start, ids, total in window:
                    yield doc, start, len(ids) // 4, zlib.crc32(ids), total, number, offset
                    offset += len(ids) // 4
                number += 1

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=OUT.names)

        for frame in frames:
            ids, texts = frame.column("doc_id").to_pylist(), [t or "" for t in frame.column("text").to_pylist()]
            for a, b in batches(texts):
                out = []
                for doc, tokens in zip(ids[a:b], own.ids(texts[a:b])):
                    tokens += end
                    out += rows(levels.add((doc, 0, tokens, len(tokens) // 4)))
                if out:
                    yield batch(out)
        if out := list(rows(levels.close())):
            yield batch(out)

    return Scratch(docs.sparkSession).keep(mapped(docs.select("doc_id", "text"), pack, OUT))
