"""Vector collections: points with payload, imported from vectors and metadata, upserted by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAYLOAD = ["title", "abstract", "authors", "categories", "doi", "journal_ref", "update_date"]


def points(vectors: DataFrame, papers: DataFrame, start: int = 0, count: int | None = None, sides: tuple[str, ...] = ("title", "abstract")) -> DataFrame:
    """point_id, the chosen vectors, payload of the rows in [start, start + count).

    A paper without metadata keeps a payload of its ids only (the other fields null). Metadata is one
    row an id; the join picks its side by size, so it is not forced into memory.
    """
    chosen = vectors.where(F.col("row_index") >= start)
    if count is not None:
        chosen = chosen.where(F.col("row_index") < start + count)
    fields = [f for f in [*PAYLOAD, "authors_parsed"] if f in papers.columns]
    some = papers.select(F.col("id").alias("_id"), F.lit(True).alias("_hit"), *fields)
    joined = chosen.join(some, F.col("paper_id") == F.col("_id"), "left")
    kinds = dict(papers.dtypes)
    filled = [F.when(F.col("_hit"), F.coalesce(F.col(f), F.lit("") if kinds[f] == "string" else F.array().cast(kinds[f]))).alias(f) for f in fields]
    payload = F.struct(F.col("paper_id").alias("id"), "paper_id", *filled)
    return joined.select(F.col("row_index").alias("point_id"), *[F.col(f"{s}_embedding").alias(s) for s in sides], payload.alias("payload"))


def upserted(stored: DataFrame, new: DataFrame, key: str = "point_id", order: str | None = None) -> DataFrame:
    """Stored rows without those that are replaced, and of each key in ``new`` the last row.

    Last by ``order``, or where none is given by the frame's own order. The result must go to another place.
    """
    placed = new.withColumn("_place", F.col(order) if order else F.monotonically_increasing_id())
    last = placed.groupBy(key).agg(F.max_by(F.struct(*[c for c in new.columns if c != key]), "_place").alias("_row"))
    one = last.select(key, "_row.*").select(*new.columns)
    return stored.join(one.select(key), key, "left_anti").unionByName(one, allowMissingColumns=True)


def _table_folder(spark: SparkSession, name: str):
    """Where a table of that name would lie, as a path and its file system."""
    session = spark._jsparkSession.sessionState()
    path = spark._jvm.org.apache.hadoop.fs.Path(session.catalog().defaultTablePath(session.sqlParser().parseTableIdentifier(name)))
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, name: str) -> None:
    """The table and what a write that was broken off has left in its folder."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    path, fs = _table_folder(spark, name)
    fs.delete(path, True)


def recover(spark: SparkSession, name: str) -> None:
    """Ends an upsert that was broken off: the next version takes the name if the old one is gone, else it goes."""
    following = f"{name}__next"
    if spark.catalog.tableExists(following) and not spark.catalog.tableExists(name):
        _table_folder(spark, name)[1].delete(_table_folder(spark, name)[0], True)
        spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
    else:
        _remove(spark, following)


def create(spark: SparkSession, name: str, sample: DataFrame, recreate: bool = False, metric: str = "cosine") -> bool:
    """An empty collection table of the sample's columns that knows its metric; False if it is there and stays."""
    recover(spark, name)
    if spark.catalog.tableExists(name):
        if not recreate:
            return False
        _remove(spark, name)
    sample.limit(0).write.saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('metric' = '{metric}')")
    return True


def metric_of(spark: SparkSession, name: str) -> str:
    """The metric that the collection was made for."""
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'metric'").first()
    return found["value"] if found else "cosine"


def upsert(spark: SparkSession, name: str, new: DataFrame, key: str = "point_id", order: str | None = None) -> None:
    """Upserts into a table: the next version is written beside it and then takes its name.

    The next version is whole before the old one is dropped. Broken off anywhere, the next call first
    ends the exchange (``recover``), so no version is lost.
    """
    recover(spark, name)
    following, metric = f"{name}__next", metric_of(spark, name)
    upserted(spark.table(name), new, key, order).write.saveAsTable(following)
    spark.sql(f"ALTER TABLE {following} SET TBLPROPERTIES ('metric' = '{metric}')")
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {name}")


def scroll(collection: DataFrame, n: int, after: int | None = None) -> DataFrame:
    """The next ``n`` points by id, after a cursor."""
    rows = collection if after is None else collection.where(F.col("point_id") > after)
    return rows.orderBy("point_id").limit(n)
