"""What a store lacks against its source, and what should be tried again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import percent


def missing_ids(source: DataFrame, stored: DataFrame, column: str = "paper_id") -> DataFrame:
    """Distinct ids of the source that are not stored. An anti join: nulls never match, and don't count."""
    ids = source.where(F.col(column).isNotNull()).select(column)
    return ids.join(stored.select(column), column, "left_anti").distinct()


def extra_ids(source: DataFrame, stored: DataFrame, column: str = "paper_id") -> DataFrame:
    return missing_ids(stored, source, column)


def common_ids(source: DataFrame, stored: DataFrame, column: str = "paper_id") -> DataFrame:
    return source.select(column).intersect(stored.select(column))


def id_diff(source: DataFrame, stored: DataFrame, column: str = "paper_id") -> DataFrame:
    """original, embedded, missing, extra, common, success_rate, same: one pass over both id sets.

    success_rate is embedded of original and can exceed 100 %.
    """
    both = source.select(column, F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(stored.select(column, F.lit(0).alias("s"), F.lit(1).alias("t")))
    each = both.where(F.col(column).isNotNull()).groupBy(column).agg(F.max("s").alias("s"), F.max("t").alias("t"))
    one = each.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in (("original", F.sum("s")), ("embedded", F.sum("t")), ("missing", F.count_if(F.expr("s > t"))), ("extra", F.count_if(F.expr("t > s"))), ("common", F.count_if(F.expr("s = t"))))])
    return one.withColumns({"success_rate": percent(F.col("embedded"), F.col("original")), "same": (F.col("missing") == 0) & (F.col("extra") == 0)})


def order_mismatches(store: DataFrame, metadata: DataFrame, column: str = "paper_id", position: str = "row_index") -> DataFrame:
    """Ids whose places differ: id, store_position, metadata_position. Ids of one side only don't count."""
    a = store.select(column, F.col(position).alias("store_position"))
    b = metadata.select(column, F.col(position).alias("metadata_position"))
    return a.join(b, column).where("store_position <> metadata_position")


def all_failed(missing: DataFrame, logged: DataFrame, column: str = "paper_id") -> DataFrame:
    return missing.select(column).unionAll(logged.select(column)).distinct()


def retry_input(papers: DataFrame, failed: DataFrame) -> DataFrame:
    """The papers to run again; written as JSON lines they are the next run's input."""
    return papers.join(failed.select(F.col("paper_id").alias("id")), "id", "left_semi")


def not_yet_embedded(papers: DataFrame, stored: DataFrame) -> DataFrame:
    """Resume: papers whose id is not in the store."""
    return papers.join(stored.select(F.col("paper_id").alias("id")), "id", "left_anti")


def from_batch(rows: DataFrame, start_batch: int, batch_size: int, position: str = "row_index") -> DataFrame:
    """Resume by batch number."""
    return rows.where(F.floor(F.col(position) / batch_size) >= start_batch)
