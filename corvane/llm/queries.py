"""The registered queries of this subpackage, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import codebooks, decontamination, filteraudit, licenses, media, neardup, onlinepacking, packing, pii, quality, sharding, tokencount, urlfilter
from .common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op11_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return onlinepacking.pack_stream(table(spark, sf_dir, "documents"), tokenizer_path())


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.digest(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3_SQL = f"""WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents), bw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s FROM bw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, i, lens.n, array_to_string(w[i:i + lens.n - 1], ' ') AS s FROM dw, lens, unnest(range(1, len(w) - lens.n + 2)) t(i)),
hits AS (SELECT doc_id, i, occ.n, item_id FROM occ JOIN win ON win.n = occ.n AND win.s = occ.s),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM hits, unnest(range(i, i + n)) t(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS items_sha256 FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP10_SQL = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 4) - 1], ' ') AS g FROM w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(d, least_id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT y, least_id FROM r JOIN e ON x = d),
c AS (SELECT d AS doc_id, min(least_id) AS component_id FROM r GROUP BY d)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept FROM documents LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)"""


_TEXT_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP12_SQL = rf"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_TEXT_WORDS} AS w FROM documents),
lab AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, list_filter([
 CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END, CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' END,
 CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END], lambda f: f IS NOT NULL) AS fails FROM d LEFT JOIN lab USING (doc_id)),
g AS (SELECT part, good, toxic, fails, count(*) AS n FROM m GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT array_to_string(o, '') AS filter_order, k AS step, o[k] AS f, o[1:k - 1] AS before FROM o, range(1, 6) t(k)),
r AS (SELECT part, filter_order, step, f, n, good, toxic, list_contains(fails, f) AS failing, list_has_any(fails, before) AS gone, len(fails) AS many FROM g CROSS JOIN s),
x AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (failing AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (failing AND gone), 0) AS redundant,
 coalesce(sum(n) FILTER (failing AND many = 1), 0) AS unique_fails, coalesce(sum(n) FILTER (failing AND NOT gone AND good), 0) AS good_lost, coalesce(sum(n) FILTER (failing AND NOT gone AND toxic), 0) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))}, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM x"""


def _codes_sql(rounds: int = 4, entries: int = 256) -> str:
    near = "SELECT vec_id, label, pos, q, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT p.*, entry, list_sum(list_transform(list_zip(q, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM p JOIN b{0} USING (pos)) GROUP BY ALL"
    steps = []
    for k in range(rounds):
        steps.append(f"a{k} AS MATERIALIZED ({near.format(k)})")
        steps.append(f"b{k + 1} AS MATERIALIZED (SELECT pos, entry, coalesce(m.e, b.e) AS e FROM b{k} b LEFT JOIN (SELECT pos, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM (SELECT pos, entry, i, CAST(sum(q[i]) AS BIGINT) AS s, count(*) AS n FROM a{k}, unnest(range(1, len(q) + 1)) t(i) GROUP BY ALL) GROUP BY ALL) m USING (pos, entry))")
    return f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, pos, v[pos * (len(v) // 4) + 1:(pos + 1) * (len(v) // 4)] AS q FROM v, range(4) t(pos)),
b0 AS MATERIALIZED (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS entry, q AS e FROM p QUALIFY entry < {entries}),
{", ".join(steps)},
c AS ({near.format(rounds)}),
r AS (SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY pos) AS code, CAST(sum(d) AS BIGINT) AS error FROM c GROUP BY ALL),
h AS (SELECT sha256(string_agg(CAST(e[i] AS VARCHAR), ',' ORDER BY pos, entry, i)) AS codebooks_sha256 FROM b{rounds}, unnest(range(1, len(e) + 1)) t(i))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM r CROSS JOIN h"""


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": OP3_SQL, "op10_near_duplicates": OP10_SQL, "op12_filter_audit": OP12_SQL, "op13_vector_codes": _codes_sql()}
