"""Best-fit packing of tokenised documents into fixed-length sequences, bulk-synchronously.

Each document is cut into pieces of at most ``capacity`` tokens. Pieces and gaps (the free ends of
sequences) have sizes from 1 to ``capacity``, so both sides, range-sorted by size, are runs of
equal sizes: at most ``capacity`` runs of pieces, each with a count. One superstep handles one run
of pieces, longest first:

1. *Successor sweep*: starting from the piece's own size, the next larger gap that exists takes as
   many pieces as fit; the sweep goes on to its successor until the run or the gaps end, and opens
   sequences for what is left. This is what best-fit-decreasing does piece by piece.
2. *Conflicts by rank*: a run's pieces have ranks 0..n-1 and a run of gaps is an interval of
   sequence numbers; rank r gets the (r // k)-th sequence of the interval when each holds k. So no
   two pieces get the same place, and no message between them is needed.
3. *Update*: the swept gaps are shortened and become runs of their new size; repeat.

The documents themselves never leave the executors. Spark counts them by size, ranks them within a
size over hash buckets (so a size that a third of all rows share is no hot task), and each piece
finds its interval by its rank. The plan's size depends on ``capacity`` and not on the number of
documents. It is broadcast below ``BROADCAST_ENTRIES``; beyond that it is unrolled and joined.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG, Scratch, mapped, ranked, schema
from .tokens import batches, tokenizer

CAPACITY, END_ID = 4096, 1
BROADCAST_ENTRIES = 1_000_000  # of five longs: 40 MB

PIECES = schema(doc_id=LONG, piece=LONG, start=LONG, length=LONG, ids_crc32=LONG)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and ``end_id``, cut at ``capacity``."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(frames):
        own = tokenizer(tokenizer_path)
        for frame in frames:
            ids, texts = frame.column("doc_id").to_pylist(), [t or "" for t in frame.column("text").to_pylist()]
            for a, b in batches(texts):
                out = []
                for doc, tokens in zip(ids[a:b], own.ids(texts[a:b])):
                    tokens += end
                    n, view = len(tokens) // 4, memoryview(tokens)
                    for piece, start in enumerate(range(0, n, capacity)):
                        stop = min(n, start + capacity)
                        out.append((doc, piece, start, stop - start, zlib.crc32(view[4 * start : 4 * stop])))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=PIECES.names)

    return mapped(docs.select("doc_id", "text"), cut, PIECES)


def superstep_plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, places in a sequence, first sequence, offset), and the sequences opened.

    ``counts`` has the number of pieces of each length. A row holds for the ranks from its first
    one to the next row's.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # free tokens -> intervals (first sequence, count)
    sizes: list[int] = []  # the sorted keys of gaps
    plan, opened = [], 0

    def add(free: int, first: int, count: int) -> None:
        if free and count:
            if free not in gaps:
                gaps[free] = []
                insort(sizes, free)
            gaps[free].append((first, count))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                free = sizes[at]
                first, count = gaps[free].pop()
                if not gaps[free]:
                    del gaps[free], sizes[at]
            else:
                free, first = capacity, opened
                count = -(-left // (capacity // length))
                opened += count
            each = free // length
            full, part = divmod(left, each)
            if full >= count:
                full, part = count, 0
            plan.append((length, rank, each, first, capacity - free))
            add(free - each * length, first, full)
            if part:
                add(free - part * length, first + full, 1)
            add(free, first + full + bool(part), count - full - bool(part))
            taken = full * each + part
            left, rank = left - taken, rank + taken
    return np.array(plan, np.int64).reshape(-1, 5), opened


def place(pieces: DataFrame, capacity: int = CAPACITY, broadcast_entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """Adds sequence_id and offset to a written table with columns doc_id, piece and length."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan, _ = superstep_plan(counts, capacity)
    order = [c for c in pieces.columns if c != "length"]
    placed = ranked(pieces, ["length"], order, "_rank", sum(counts.values()))
    kinds = schema(**{f.name: f.dataType for f in placed.schema}, sequence_id=LONG, offset=LONG)
    if len(plan) <= broadcast_entries:
        shared = spark.sparkContext.broadcast(plan)

        def assign(frames):
            rows = shared.value
            key = rows[:, 0] * (1 << 44) + rows[:, 1]
            by = np.argsort(key, kind="stable")
            key = key[by]
            for frame in frames:
                length, rank = (frame.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
                entry = rows[by[np.searchsorted(key, length * (1 << 44) + rank, "right") - 1]]
                step, inside = np.divmod(rank - entry[:, 1], entry[:, 2])
                yield pa.RecordBatch.from_arrays([*frame.columns, pa.array(entry[:, 3] + step), pa.array(entry[:, 4] + inside * length)], names=kinds.names)

        return mapped(placed, assign, kinds).drop("_rank")
    ends = np.append(plan[1:, 1], 0)
    same = np.append(plan[1:, 0] == plan[:-1, 0], False)
    ends = np.where(same, ends, [counts[x] for x in plan[:, 0].tolist()])
    entries = spark.createDataFrame([(*map(int, r), int(e)) for r, e in zip(plan, ends)], "_length long, _first long, _each long, _sequence long, _offset long, _end long")
    unrolled = entries.select("*", F.explode(F.sequence("_first", F.col("_end") - 1)).alias("_at"))
    inside = F.col("_rank") - F.col("_first")
    return placed.join(unrolled, (F.col("length") == F.col("_length")) & (F.col("_rank") == F.col("_at"))).select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(inside / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(inside, F.col("_each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row a piece of every document.

    A null or empty text is one piece of the end id alone; a very long one is cut at ``capacity``
    only; equal texts and repeated rows each get a place of their own; an empty table gives an
    empty result; columns besides doc_id and text are ignored.
    """
    pieces = Scratch(docs.sparkSession).keep(token_pieces(docs, tokenizer_path, capacity, end_id))
    out = place(pieces, capacity)
    return out.withColumn("piece", F.col("piece").cast("int"))
