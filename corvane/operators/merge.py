"""Merging vector tables: compatibility, union, keep-first, manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def incompatibilities(shards: Sequence[DataFrame]) -> list[str]:
    """Why shards cannot be merged: other columns, or vectors of another size. Element types may differ."""
    out, first = [], shards[0]
    arrays = [c for c, kind in first.dtypes if kind.startswith("array")]
    expected = first.agg(*[F.max(F.size(c)).alias(c) for c in arrays]).first()
    for i, shard in enumerate(shards):
        if set(shard.columns) != set(first.columns):
            out.append(f"shard {i}: columns {sorted(shard.columns)} instead of {sorted(first.columns)}")
            continue
        ends = shard.agg(*[f(F.size(c)).alias(f"{c}_{k}") for c in arrays for k, f in (("low", F.min), ("high", F.max))]).first()
        out += [f"shard {i}: {c} has {ends[f'{c}_low']} to {ends[f'{c}_high']} values instead of {expected[c]}" for c in arrays if ends[f"{c}_low"] is not None and {ends[f"{c}_low"], ends[f"{c}_high"]} != {expected[c]}]
    return out


def keep_first(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row a key, the first by ``order``.

    A grouped minimum, not a window: duplicates are combined before the shuffle, so a key that many
    rows share is no hot task.
    """
    others = [c for c in rows.columns if c not in (key, *order)]
    first = rows.groupBy(key).agg(F.min_by(F.struct(*order, *others), F.struct(*order)).alias("r"))
    return first.select(key, "r.*").select(*rows.columns)


def merge(shards: Sequence[DataFrame], key: str = "paper_id", position: str = "row_index", remove_duplicates: bool = True) -> DataFrame:
    """Rows of all shards in order of shard, then position, with ``shard``; keeps the first of an id by default."""
    union = None
    for i, s in enumerate(shards):
        numbered = s.withColumn("shard", F.lit(i))
        union = numbered if union is None else union.unionByName(numbered)
    return keep_first(union, key, "shard", position) if remove_duplicates else union


def assert_equal_lengths(merged: DataFrame, arrays: Sequence[str] | None = None) -> int:
    """The number of rows; ValueError if one lacks a vector or has one of another length than the others."""
    columns = arrays or [c for c, kind in merged.dtypes if kind.startswith("array")]
    one = merged.agg(F.count(F.lit(1)).alias("n"), *[f.alias(f"{c}_{k}") for c in columns for k, f in (("n", F.count(c)), ("low", F.min(F.size(c))), ("high", F.max(F.size(c))))]).first()
    bad = [c for c in columns if one[f"{c}_n"] != one["n"] or one[f"{c}_low"] != one[f"{c}_high"]]
    if bad:
        raise ValueError(f"{', '.join(bad)}: not one vector of one length a row")
    return one["n"]


def duplicate_count(shards: Sequence[DataFrame], key: str = "paper_id") -> DataFrame:
    """total, unique_ids, duplicates."""
    union = shards[0].select(key)
    for s in shards[1:]:
        union = union.unionAll(s.select(key))
    counts = union.groupBy(key).count()
    return counts.agg(F.sum("count").cast("long").alias("total"), F.count(F.lit(1)).alias("unique_ids")).withColumn("duplicates", F.col("total") - F.col("unique_ids"))


def manifest(shards: Sequence[DataFrame], names: Sequence[str], merged_rows: int) -> DataFrame:
    """One row: merge_info and the details of each file (columns, rows), as a sidecar."""
    details = [{"filename": n, "rows": s.count(), "datasets": dict(s.dtypes)} for n, s in zip(names, shards)]
    total = sum(d["rows"] for d in details)
    row = ({"files": len(details), "total_rows": total, "merged_rows": merged_rows, "duplicates": total - merged_rows}, details)
    return shards[0].sparkSession.createDataFrame([row], "merge_info struct<files: int, total_rows: bigint, merged_rows: bigint, duplicates: bigint>, file_details array<struct<filename: string, rows: bigint, datasets: map<string, string>>>")
