"""Completeness and length profiles of paper metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import OPTIONAL_FIELDS, REQUIRED_FIELDS
from .quantiles import exact_quantiles

EDGES = (0, 128, 256, 512, 1024, 2048, 4096, 8192)
PERCENTILES = (50, 90, 95, 99, 99.9)


def _state(keys: Column, parsed: Column, name: str) -> Column:
    value = F.variant_get(parsed, f"$['{name}']", "variant")
    text = F.variant_get(value, "$", "string")
    falsy = F.coalesce(F.when(F.schema_of_variant(value) == "STRING", text == "").otherwise(text.isin("[]", "{}", "0", "0.0", "-0", "-0.0", "false")), F.lit(True))
    return F.when(~F.array_contains(keys, name), "missing").when(falsy, "empty").otherwise("ok")


def field_state(raw: Column, name: str) -> Column:
    """``missing`` if the key is absent, ``empty`` if its value is null, empty text, an empty list or
    object, zero or false, else ``ok``."""
    return _state(F.json_object_keys(raw), F.try_parse_json(raw), name)


def objects_only(lines: DataFrame, raw: str = "value") -> DataFrame:
    return lines.where(F.try_parse_json(F.col(raw)).isNotNull() & F.trim(F.col(raw)).startswith("{"))


def _with_parsed(lines: DataFrame, raw: str) -> DataFrame:
    """Objects with ``_keys`` and ``_parsed``: each line is parsed once, whatever the number of fields."""
    return objects_only(lines, raw).withColumns({"_keys": F.json_object_keys(F.col(raw)), "_parsed": F.try_parse_json(F.col(raw))})


def completeness(lines: DataFrame, required: Sequence[str] = REQUIRED_FIELDS, optional: Sequence[str] = OPTIONAL_FIELDS, raw: str = "value") -> DataFrame:
    """field, required, total, valid, missing, missing_rate, empty, empty_rate in one pass over JSON lines.

    total and valid are the same in each row; malformed lines don't count; rates are percentages, 0 of nothing.
    """
    fields = [(f, True) for f in required] + [(f, False) for f in optional]
    good = _with_parsed(lines, raw).select(*[_state(F.col("_keys"), F.col("_parsed"), f).alias(f"s{i}") for i, (f, _) in enumerate(fields)])
    valid = F.lit(True)
    for i, (_, needed) in enumerate(fields):
        if needed:
            valid = valid & (F.col(f"s{i}") == "ok")
    counts = [F.count_if(F.col(f"s{i}") == kind).alias(f"{kind}{i}") for i in range(len(fields)) for kind in ("missing", "empty")]
    one = good.agg(F.count(F.lit(1)).alias("total"), F.count_if(valid).alias("valid"), *counts)

    def rate(c: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(c * 100.0, F.col("total")), F.lit(0.0)), 6)

    entries = [F.struct(F.lit(f).alias("field"), F.lit(needed).alias("required"), "total", "valid", F.col(f"missing{i}").alias("missing"), rate(F.col(f"missing{i}")).alias("missing_rate"), F.col(f"empty{i}").alias("empty"), rate(F.col(f"empty{i}")).alias("empty_rate")) for i, (f, needed) in enumerate(fields)]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def valid_rate(lines: DataFrame, required: Sequence[str] = REQUIRED_FIELDS, raw: str = "value") -> DataFrame:
    """total, valid, valid_rate (percent, 0 of nothing): lines whose required fields are all there and not empty."""
    good = _with_parsed(lines, raw).select(F.array(*[_state(F.col("_keys"), F.col("_parsed"), f) == "ok" for f in required]).alias("ok"))
    one = good.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.forall("ok", lambda x: x)).alias("valid"))
    return one.withColumn("valid_rate", F.round(F.coalesce(F.try_divide(F.col("valid") * 100.0, F.col("total")), F.lit(0.0)), 6))


def summary_text(rows: DataFrame, column: str, order: str, text: str, most: int, clip: int = 2000) -> DataFrame:
    """line, value: a text report of lengths, with the longest text clipped."""
    stats, top, share = length_stats(rows, column), longest(rows, column, order, text), processable(rows, column, most)
    one = stats.crossJoin(top.select(F.col(order).alias("_at"), F.when(F.length(text) > clip, F.concat(F.left(text, F.lit(clip)), F.lit("..."))).otherwise(F.col(text)).alias("_shown"))).crossJoin(share.select("processable", "percent"))  # one row each
    lines = [F.format_string("texts: %d", "total"), F.format_string("mean length: %.2f", "mean"), F.format_string("median length: %.2f", "median"), F.format_string("longest: %d (at %s)", F.col("longest"), F.col("_at").cast("string")), F.format_string(f"up to {most}: %d (%.2f%%)", "processable", "percent"), F.concat(F.lit("longest text: "), "_shown")]
    return one.select(F.posexplode(F.array(*lines)).alias("line", "value"))


def complete_lines(lines: DataFrame, required: Sequence[str] = REQUIRED_FIELDS, raw: str = "value") -> DataFrame:
    """The lines whose required fields are all there and not empty."""
    states = _with_parsed(lines, raw).withColumn("_ok", F.array(*[_state(F.col("_keys"), F.col("_parsed"), f) == "ok" for f in required]))
    return states.where(F.forall("_ok", lambda ok: ok)).select(*lines.columns)


def sample_lines(lines: DataFrame, n: int, raw: str = "value", seed: int = 0) -> DataFrame:
    """At most ``n`` lines without replacement, reproducibly: by an MD5 of seed and line."""
    return lines.orderBy(F.md5(F.concat(F.lit(str(seed)), raw).cast("binary")), raw).limit(n)


def length_stats(lengths: DataFrame, column: str) -> DataFrame:
    """total, mean, median, population std, max in one row; the median is exact (``quantiles``)."""
    c = F.col(column)
    (median,) = exact_quantiles(lengths, column, [0.5])
    return lengths.agg(F.count(c).alias("total"), F.avg(c).alias("mean"), F.lit(median).cast("double").alias("median"), F.stddev_pop(c).alias("std"), F.max(c).alias("longest"))


def length_percentiles(lengths: DataFrame, column: str, percents: Sequence[float] = PERCENTILES) -> DataFrame:
    """percent, value by linear interpolation, exactly (``quantiles``)."""
    found = exact_quantiles(lengths, column, [p / 100 for p in percents])
    return lengths.sparkSession.createDataFrame([(float(p), v) for p, v in zip(percents, found)], "percent double, value double")


def length_histogram(lengths: DataFrame, column: str, edges: Sequence[int] = EDGES) -> DataFrame:
    """bin, low, high (inclusive), n, percent; empty bins stay, the last one ends at the longest.

    One pass: the bins are counted as conditional sums, whatever their number.
    """
    c = F.col(column)
    inside = [(c >= lo) & (c < hi) for lo, hi in zip(edges, edges[1:])] + [c >= edges[-1]]
    one = lengths.agg(F.count(c).alias("total"), F.max(c).alias("longest"), *[F.count_if(x).alias(f"n{i}") for i, x in enumerate(inside)])
    highs = [F.lit(e - 1).cast("long") for e in edges[1:]] + [F.col("longest").cast("long")]
    entries = [F.struct(F.lit(i).alias("bin"), F.lit(lo).cast("long").alias("low"), hi.alias("high"), F.col(f"n{i}").alias("n"), F.round(F.coalesce(F.try_divide(F.col(f"n{i}") * 100.0, F.col("total")), F.lit(0.0)), 6).alias("percent")) for i, (lo, hi) in enumerate(zip(edges, highs))]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def longest(rows: DataFrame, column: str, order: str, *carried: str) -> DataFrame:
    """The row with the largest value; of ties the one with the least ``order``."""
    return rows.agg(F.max_by(F.struct(order, column, *[c for c in carried if c not in (order, column)]), F.struct(F.col(column), -F.col(order))).alias("r")).select("r.*")


def processable(lengths: DataFrame, column: str, most: int) -> DataFrame:
    """total, processable, percent of texts that a model of ``most`` tokens takes whole."""
    one = lengths.agg(F.count(column).alias("total"), F.count_if(F.col(column) <= most).alias("processable"))
    return one.withColumn("percent", F.round(F.coalesce(F.try_divide(F.col("processable") * 100.0, F.col("total")), F.lit(0.0)), 6))
