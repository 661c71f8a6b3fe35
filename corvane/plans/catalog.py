"""All registered queries of the engine, each with its SQL twin where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vector as V
from ..operators import bounded, clustered, collection, compare, embed, merge, profile, quality, reconcile, sampling, search
from ..schemas import PUBMED_COLUMNS
from ..sources import papers as S
from ..sources import hdf5, npz, pubmed, sinks, stores
from ..sources.hdf5 import as_path
from ..streaming import incremental
from . import fixtures as D

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
K = 10


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _hits(df: DataFrame) -> DataFrame:
    return df.select("paper_id", r6("score").alias("score"), F.col("rank").cast("long").alias("rank"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def _top_sql(score: str, where: str = "", order: str = "DESC", k: int = K) -> str:
    return f"""WITH {D.CORPUS_SQL}, {D.QUERY_SQL}, s AS (SELECT paper_id, {score} AS score FROM pv CROSS JOIN qv), b AS (SELECT * FROM s {where} ORDER BY score {order}, paper_id LIMIT {k})
SELECT paper_id, round(score, 6) AS score, row_number() OVER (ORDER BY score {order}, paper_id) AS rank FROM b"""


_T, _A = "list_cosine_similarity(t, q)", "list_cosine_similarity(ab, q)"


# Search


@query(_top_sql(_T))
def topk_bounded(spark, sf):
    """Title search over blocks whose rows are left when a bound says so; norms are stored with the vectors."""
    q = D.query_vector(spark, sf).first()["q"]
    return _hits(search.bounded_search(bounded.with_group_norms(D.corpus(spark, sf), ("title",), 16), q, K, group=16))


@query(_top_sql(f"0.3 * {_T} + 0.7 * {_A}"))
def topk_bounded_combined(spark, sf):
    return _hits(search.bounded_search(D.corpus(spark, sf), D.query_vector(spark, sf).first()["q"], K, "combined", group=16))


@query(_top_sql(_T))
def topk_title(spark, sf):
    return _hits(search.search(D.corpus(spark, sf), D.query_vector(spark, sf), K))


@query(_top_sql(_A))
def topk_abstract(spark, sf):
    return _hits(search.search(D.corpus(spark, sf), D.query_vector(spark, sf), K, "abstract"))


@query(_top_sql(f"0.3 * {_T} + 0.7 * {_A}"))
def topk_combined_exact(spark, sf):
    return _hits(search.search_combined(D.corpus(spark, sf), D.query_vector(spark, sf), K))


@query(
    f"""WITH {D.CORPUS_SQL}, {D.QUERY_SQL}, s AS (SELECT paper_id, {_T} AS st, {_A} AS sa FROM pv CROSS JOIN qv),
c AS (SELECT * FROM (SELECT paper_id, 0.3 * st AS part FROM s ORDER BY st DESC, paper_id LIMIT {3 * K}) UNION ALL SELECT * FROM (SELECT paper_id, 0.7 * sa FROM s ORDER BY sa DESC, paper_id LIMIT {3 * K})),
b AS (SELECT paper_id, sum(part) AS score FROM c GROUP BY paper_id ORDER BY score DESC, paper_id LIMIT {K})
SELECT paper_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, paper_id) AS rank FROM b"""
)
def topk_combined_candidate(spark, sf):
    return _hits(search.search_candidates(D.corpus(spark, sf), D.query_vector(spark, sf), K))


@query(_top_sql("list_cosine_similarity(list_transform(list_zip(t, ab), lambda x: (x[1] + x[2]) / 2), q)"))
def topk_mean_vector(spark, sf):
    return _hits(search.search_mean(D.corpus(spark, sf), D.query_vector(spark, sf), K))


@query(_top_sql(_T, "WHERE score >= 0.3", k=50))
def topk_threshold(spark, sf):
    return _hits(search.search(D.corpus(spark, sf), D.query_vector(spark, sf), 50, threshold=0.3))


@query(_top_sql("list_dot_product(t, q)"))
def topk_dot(spark, sf):
    return _hits(search.search(D.corpus(spark, sf), D.query_vector(spark, sf), K, metric="dot"))


@query(_top_sql("list_distance(t, q)", order="ASC"))
def topk_euclidean(spark, sf):
    return _hits(search.search(D.corpus(spark, sf), D.query_vector(spark, sf), K, metric="euclidean"))


@query(_top_sql("list_cosine_similarity(t, q)").replace("WHERE vec_id = 0", "WHERE vec_id = 7"))
def similar_to_id(spark, sf):
    return _hits(search.similar_to(D.corpus(spark, sf), "7", K))


@query(
    f"""WITH {D.CORPUS_SQL}, {D.QUERY_SQL}, {D.PAPERS_SQL}, b AS (SELECT paper_id, {_T} AS score FROM pv CROSS JOIN qv ORDER BY score DESC, paper_id LIMIT {K})
SELECT paper_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, paper_id) AS rank, coalesce(title, '') AS title, coalesce(categories, '') AS categories FROM b LEFT JOIN papers ON id = paper_id"""
)
def search_with_metadata(spark, sf):
    hits = _hits(search.search(D.corpus(spark, sf), D.query_vector(spark, sf), K))
    return search.with_metadata(hits, D.papers(spark, sf), ("title", "categories"))


@query(
    f"""WITH {D.CORPUS_SQL}, s AS (SELECT a.row_index AS query_id, b.paper_id, list_cosine_similarity(a.t, b.t) AS score FROM pv a CROSS JOIN pv b),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, paper_id) AS rank FROM s) SELECT query_id, paper_id, round(score, 6) AS score, rank FROM n WHERE rank <= 5"""
)
def multi_query_topk(spark, sf):
    c = D.corpus(spark, sf)
    found = search.multi_search(c, c.select(F.col("row_index").alias("query_id"), F.col("title_embedding").alias("q")), 5)
    return found.select("query_id", "paper_id", r6("score").alias("score"), F.col("rank").cast("long").alias("rank"))


def _multi_sql(score: str, order: str = "DESC") -> str:
    """Five hits of every row whose number is divisible by 50, without rows that have no vector."""
    return f"""WITH {D.CORPUS_SQL}, c AS (SELECT * FROM pv WHERE row_index % 11 NOT IN (5, 6)), s AS (SELECT a.row_index AS query_id, b.paper_id, {score} AS score FROM pv a CROSS JOIN c b WHERE a.row_index % 50 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, paper_id) AS rank FROM s) SELECT query_id, paper_id, round(score, 6) AS score, rank FROM n WHERE rank <= 5"""


def _multi(spark, sf, side: str, metric: str) -> DataFrame:
    """Every eleventh row has a null vector, the one after it a vector with a NaN: they are no hits."""
    c = D.corpus(spark, sf)
    queries = c.where("row_index % 50 = 0").select(F.col("row_index").cast("int").alias("query_id"), F.col(f"{side}_embedding").alias("q"))
    at = F.col("row_index") % 11
    broken = c.withColumn(f"{side}_embedding", F.when(at == 6, F.transform(f"{side}_embedding", lambda x: F.lit(float("nan")).cast("float"))).when(at != 5, F.col(f"{side}_embedding")))
    found = search.multi_search(broken, queries, 5, side, metric=metric)
    return found.select(F.col("query_id").cast("long").alias("query_id"), "paper_id", r6("score").alias("score"), F.col("rank").cast("long").alias("rank"))


@query(_multi_sql("list_cosine_similarity(a.ab, b.ab)"))
def multi_query_abstract(spark, sf):
    return _multi(spark, sf, "abstract", "cosine")


@query(_multi_sql("list_dot_product(a.t, b.t)"))
def multi_query_dot(spark, sf):
    return _multi(spark, sf, "title", "dot")


@query(_multi_sql("list_distance(a.t, b.t)", "ASC"))
def multi_query_euclidean(spark, sf):
    return _multi(spark, sf, "title", "euclidean")


def _paper_store(spark, sf):
    """All vectors as points of a clustered store."""
    rows = D.corpus(spark, sf).withColumn("point_id", F.col("row_index"))
    store = clustered.PaperStore.create(spark, D.folder(spark), rows, width=100, buckets=8)
    store.upsert(rows)
    return store


@query(f"WITH {D.CORPUS_SQL} SELECT paper_id, row_index, CAST(len(t) AS BIGINT) AS title_dim, CAST(len(ab) AS BIGINT) AS abstract_dim FROM pv WHERE paper_id = '42'")
def point_lookup(spark, sf):
    return search.lookup(_paper_store(spark, sf).of_paper("42"), "42").select("paper_id", "row_index", F.col("title_dim").cast("long").alias("title_dim"), F.col("abstract_dim").cast("long").alias("abstract_dim"))


@query(f"WITH {D.CORPUS_SQL} SELECT paper_id, row_index, CAST(len(t) AS BIGINT) AS title_dim, CAST(len(ab) AS BIGINT) AS abstract_dim FROM pv WHERE row_index = 17")
def point_lookup_index(spark, sf):
    return search.lookup_index(_paper_store(spark, sf).of_point(17), 17).select("paper_id", "row_index", F.col("title_dim").cast("long").alias("title_dim"), F.col("abstract_dim").cast("long").alias("abstract_dim"))


# Vectors

_PAIR = "list_cosine_similarity(t, ab)"


@query(f"WITH {D.CORPUS_SQL} SELECT paper_id, round({_PAIR}, 6) AS similarity FROM pv")
def pair_cosine(spark, sf):
    return D.corpus(spark, sf).select("paper_id", r6(V.cosine("title_embedding", "abstract_embedding")).alias("similarity"))


@query(f"WITH {D.CORPUS_SQL}, s AS (SELECT {_PAIR} AS c FROM pv) SELECT round(avg(c), 6) AS mean, round(stddev_pop(c), 6) AS std, round(min(c), 6) AS least, round(max(c), 6) AS largest FROM s")
def pair_cosine_stats(spark, sf):
    return _rounded(quality.pair_stats(D.corpus(spark, sf)))


@query("WITH x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) SELECT vec_id, round(sqrt(sum(v * v)), 6) AS norm, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS least, round(max(v), 6) AS largest FROM x GROUP BY vec_id")
def vector_row_stats(spark, sf):
    return _rounded(quality.row_stats(D.table(spark, sf, "embeddings"), "vec_id", "embedding"))


@query(
    """WITH x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), n AS (SELECT avg(s) AS mean_norm FROM (SELECT sqrt(sum(v * v)) AS s FROM x GROUP BY vec_id))
SELECT count(*) AS n_values, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS least, round(max(v), 6) AS largest, round(count(*) FILTER (WHERE v = 0) / count(*), 6) AS zero_share,
 (SELECT round(mean_norm, 6) FROM n) AS mean_norm, count(*) FILTER (WHERE isnan(v)) AS nan_count FROM x"""
)
def vector_matrix_stats(spark, sf):
    return _rounded(quality.matrix_stats(D.table(spark, sf, "embeddings"), "embedding"))


_DIMS = "x AS (SELECT unnest(range(1, len(embedding) + 1)) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), d AS (SELECT CAST(dim AS BIGINT) AS dim, avg(v) AS mean, stddev_pop(v) AS std, min(v) AS least, max(v) AS largest FROM x GROUP BY dim)"


@query(f"WITH {_DIMS} SELECT dim, round(mean, 6) AS mean, round(std, 6) AS std, round(least, 6) AS least, round(largest, 6) AS largest FROM d")
def vector_dim_stats(spark, sf):
    return _rounded(quality.dimension_stats(D.table(spark, sf, "embeddings"), "embedding"))


@query(f"WITH {_DIMS} " + " UNION ALL ".join(f"SELECT '{n}' AS statistic, round(min({n}), 6) AS low, round(max({n}), 6) AS high FROM d" for n in ("mean", "std", "least", "largest")))
def vector_dim_ranges(spark, sf):
    return _rounded(quality.dimension_ranges(quality.dimension_stats(D.table(spark, sf, "embeddings"), "embedding")))


def _histogram_sql(value: str) -> str:
    return f"""WITH {D.CORPUS_SQL}, s AS (SELECT {value} AS v FROM pv), e AS (SELECT min(v) AS lo, max(v) AS hi FROM s)
SELECT CAST(least(floor((v - lo) / ((hi - lo) / 50)) + 1, 50) AS INTEGER) AS bin, count(*) AS n FROM s CROSS JOIN e GROUP BY 1"""


@query(_histogram_sql("round(sqrt(list_sum(list_transform(list_zip(t, ab), lambda x: pow((x[1] + x[2]) / 2, 2)))), 6)"))
def norm_histogram(spark, sf):
    norms = D.corpus(spark, sf).select(r6(V.norm(V.mean_of("title_embedding", "abstract_embedding"))).alias("v"))
    return quality.equal_width_histogram(norms, "v")


@query(_histogram_sql(f"round({_PAIR}, 6)"))
def similarity_histogram(spark, sf):
    return quality.equal_width_histogram(D.corpus(spark, sf).select(r6(V.cosine("title_embedding", "abstract_embedding")).alias("v")), "v")


@query(f"WITH {D.CORPUS_SQL}, s AS (SELECT sqrt(list_sum(list_transform(t, lambda x: x * x))) AS n FROM pv) SELECT round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std, round(min(n), 6) AS least, round(max(n), 6) AS largest FROM s")
def norm_stats(spark, sf):
    return _rounded(quality.norm_stats(D.corpus(spark, sf), "title_embedding"))


@query(
    f"""WITH {D.CORPUS_SQL}, o AS (SELECT count(*) - count(DISTINCT label) AS dup, count(*) FILTER (WHERE t IS NULL) AS tm, max(len(t)) - min(len(t)) AS td, count(*) FILTER (WHERE ab IS NULL) AS am, max(len(ab)) - min(len(ab)) AS ad, count(*) FILTER (WHERE len(t) <> len(ab)) AS bs FROM pv),
c AS (SELECT unnest([{{'check': 'duplicate_ids', 'value': dup}}, {{'check': 'title_embedding_missing', 'value': tm}}, {{'check': 'title_embedding_dims', 'value': td}}, {{'check': 'title_embedding_nan_rows', 'value': 0}},
 {{'check': 'abstract_embedding_missing', 'value': am}}, {{'check': 'abstract_embedding_dims', 'value': ad}}, {{'check': 'abstract_embedding_nan_rows', 'value': 0}}, {{'check': 'dims_between_sides', 'value': bs}}]) AS e FROM o)
SELECT e['check'] AS "check", CAST(e['value'] AS BIGINT) AS value, e['value'] = 0 AS ok FROM c"""
)
def integrity_report(spark, sf):
    return quality.integrity(D.corpus(spark, sf), "label")


@query(
    f"""WITH {D.CORPUS_SQL}, x AS (SELECT paper_id, unnest(list_transform(list_zip(t, ab), lambda e: abs(e[1] - e[2]))) AS d FROM pv)
SELECT paper_id, round(avg(d), 6) AS mean_difference, round(max(d), 6) AS max_difference, round(stddev_pop(d), 6) AS std_difference FROM x GROUP BY paper_id"""
)
def absdiff_stats(spark, sf):
    d = D.corpus(spark, sf).withColumn("d", V.abs_difference("title_embedding", "abstract_embedding"))
    return _rounded(d.select("paper_id", V.element_mean("d").alias("mean_difference"), F.array_max("d").alias("max_difference"), V.element_std("d").alias("std_difference")))


@query(
    f"""WITH {D.CORPUS_SQL}, b AS (SELECT row_index AS text_id, 'one' AS backend, t AS v FROM pv UNION ALL SELECT row_index, 'two', ab FROM pv UNION ALL SELECT row_index, 'three', t FROM pv),
p AS (SELECT x.text_id, x.backend AS backend_a, y.backend AS backend_b, list_cosine_similarity(x.v, y.v) AS s FROM b x JOIN b y ON x.text_id = y.text_id AND x.backend < y.backend)
SELECT text_id, backend_a, backend_b, round(s, 6) AS similarity, CASE WHEN s > 0.99 THEN 'high' WHEN s > 0.95 THEN 'similar' ELSE 'different' END AS grade FROM p"""
)
def similarity_grade(spark, sf):
    c = D.corpus(spark, sf)
    sides = [("one", "title_embedding"), ("two", "abstract_embedding"), ("three", "title_embedding")]
    backends = None
    for name, column in sides:
        part = c.select(F.col("row_index").alias("text_id"), F.lit(name).alias("backend"), F.col(column).alias("v"))
        backends = part if backends is None else backends.unionAll(part)
    return compare.agreement(backends).select("text_id", "backend_a", "backend_b", r6("similarity").alias("similarity"), "grade")


@query(
    f"""WITH {D.CORPUS_SQL}, u AS (SELECT paper_id, unnest(range(1, len(t) + 1)) AS dim, unnest(t) AS a, unnest(ab) AS b FROM pv)
SELECT paper_id, CAST(dim AS BIGINT) AS dim, round(a, 6) AS a, round(b, 6) AS b, round(abs(a - b), 6) AS difference FROM u WHERE dim <= 50"""
)
def difference_table(spark, sf):
    d = compare.difference_table(D.corpus(spark, sf).select("paper_id", "title_embedding", "abstract_embedding"), "title_embedding", "abstract_embedding")
    return _rounded(d.withColumn("dim", (F.col("dim") + 1).cast("long")))


@query(
    """WITH x AS (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v, sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda e: e * e))) AS n FROM embeddings)
SELECT vec_id, CAST(dim AS BIGINT) AS dim, round(v / n, 6) AS value FROM x"""
)
def unit_vectors(spark, sf):
    u = D.table(spark, sf, "embeddings").select("vec_id", F.posexplode(V.unit("embedding")).alias("dim", "value"))
    return u.select("vec_id", (F.col("dim") + 1).cast("long").alias("dim"), r6("value").alias("value"))


@query("SELECT vec_id, array_to_string(list_transform(embedding[1:10], lambda x: format('{:.8f}', CAST(x AS DOUBLE))), ' ') AS preview FROM embeddings")
def vector_preview(spark, sf):
    return D.table(spark, sf, "embeddings").select("vec_id", F.array_join(V.preview("embedding"), " ").alias("preview"))


@query("SELECT min(len(embedding)) AS dim_min, max(len(embedding)) AS dim_max, count(*) AS rows FROM embeddings")
def store_structure(spark, sf):
    s = stores.store_structure(D.table(spark, sf, "embeddings")).where("name = 'embedding'")
    return s.select(F.col("dim_min").cast("long").alias("dim_min"), F.col("dim_max").cast("long").alias("dim_max"), "rows")


# Papers


@query(f"WITH {D.PAPERS_SQL} SELECT id, title, replace(abstract, chr(10), ' ') AS abstract, categories, journal_ref FROM papers")
def papers_normalised(spark, sf):
    fields = F.struct("id", "title", "abstract", "categories", F.col("journal_ref").alias("journal-ref"))
    lines = D.papers(spark, sf).select(F.to_json(fields).alias("value"))
    return S.normalised(S.parsed(lines)).select("id", "title", "abstract", "categories", "journal_ref")


_DEFECTS = "j AS (SELECT CAST(doc_id AS VARCHAR) AS id, doc_id AS row_index, lang, source, text FROM documents WHERE source <> 'src7')"


@query(f"WITH {_DEFECTS} SELECT id, 'a title' AS title, replace(text, chr(10), ' ') AS abstract, lang AS categories FROM j WHERE lang = 'en' AND text <> ''")
def valid_papers(spark, sf):
    lines = D.json_lines(spark, sf).select("row_index", "value")
    return S.valid(S.parsed(lines)).select("id", "title", "abstract", "categories")


@query(
    f"""WITH {_DEFECTS}, c AS (SELECT count(*) AS total, count(*) FILTER (WHERE lang = 'en' AND text <> '') AS valid, count(*) FILTER (WHERE lang = 'fr') AS tm, count(*) FILTER (WHERE lang IN ('de', 'es')) AS te, count(*) FILTER (WHERE text = '') AS ae FROM j),
f AS (SELECT unnest([{{'field': 'id', 'm': 0, 'e': 0}}, {{'field': 'title', 'm': tm, 'e': te}}, {{'field': 'abstract', 'm': 0, 'e': ae}}, {{'field': 'authors', 'm': total, 'e': 0}}, {{'field': 'categories', 'm': 0, 'e': 0}}, {{'field': 'journal-ref', 'm': total, 'e': 0}}, {{'field': 'doi', 'm': 0, 'e': total}}, {{'field': 'update_date', 'm': total, 'e': 0}}]) AS x, total, valid FROM c)
SELECT x['field'] AS field, total, valid, CAST(x['m'] AS BIGINT) AS missing, round(x['m'] * 100.0 / total, 6) AS missing_rate, CAST(x['e'] AS BIGINT) AS "empty", round(x['e'] * 100.0 / total, 6) AS empty_rate FROM f"""
)
def completeness_profile(spark, sf):
    return profile.completeness(D.json_lines(spark, sf)).drop("required")


@query(f"WITH {_DEFECTS} SELECT id FROM j WHERE lang = 'en' AND text <> ''")
def json_roundtrip_validity(spark, sf):
    return profile.complete_lines(D.json_lines(spark, sf)).select("id")


_WORDS = "w AS (SELECT doc_id, CASE WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) END AS n FROM documents)"


def _lengths(spark, sf):
    return D.table(spark, sf, "documents").select("doc_id", X.word_count(F.col("text")).alias("n"))


@query(f"WITH {_WORDS} SELECT count(n) AS total, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6) AS median, round(stddev_pop(n), 6) AS std, CAST(max(n) AS BIGINT) AS longest FROM w")
def length_stats(spark, sf):
    return _rounded(profile.length_stats(_lengths(spark, sf), "n"))


@query(f"WITH {_WORDS} " + " UNION ALL ".join(f"SELECT {float(p)}::DOUBLE AS percent, round(quantile_cont(n, {p / 100}), 6) AS value FROM w" for p in profile.PERCENTILES))
def length_percentiles(spark, sf):
    return _rounded(profile.length_percentiles(_lengths(spark, sf), "n"))


@query(
    f"""WITH {_WORDS}, t AS (SELECT count(*) AS total, max(n) AS longest FROM w), b AS (SELECT * FROM (VALUES (0, 0, 127), (1, 128, 255), (2, 256, 511), (3, 512, 1023), (4, 1024, 2047), (5, 2048, 4095), (6, 4096, 8191), (7, 8192, 1000000000000)) v(bin, low, high)),
c AS (SELECT bin, low, high, count(n) AS n FROM b LEFT JOIN w ON w.n BETWEEN low AND high GROUP BY ALL)
SELECT bin, CAST(low AS BIGINT) AS low, CAST(CASE WHEN bin = 7 THEN longest ELSE high END AS BIGINT) AS high, n, round(n * 100.0 / total, 6) AS percent FROM c CROSS JOIN t"""
)
def length_histogram(spark, sf):
    return profile.length_histogram(_lengths(spark, sf), "n")


@query("SELECT doc_id, n_chars, left(text, 500) || CASE WHEN length(text) > 500 THEN '...' ELSE '' END AS shown FROM documents ORDER BY n_chars DESC, doc_id LIMIT 1")
def longest_document(spark, sf):
    top = profile.longest(D.table(spark, sf, "documents"), "n_chars", "doc_id", "text")
    return top.select("doc_id", "n_chars", X.shortened(F.col("text"), 500).alias("shown"))


@query(f"WITH {_WORDS} SELECT count(*) AS total, count(*) FILTER (WHERE n <= 512) AS processable, round(count(*) FILTER (WHERE n <= 512) * 100.0 / count(*), 6) AS percent FROM w")
def processable_share(spark, sf):
    return profile.processable(_lengths(spark, sf), "n", 512)


@query("WITH l AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS line FROM documents) SELECT CAST(doc_id AS VARCHAR) AS id, line AS row_index FROM l WHERE line >= 100 AND source <> 'src7' AND lang = 'en' AND text <> '' ORDER BY line LIMIT 50")
def skip_limit(spark, sf):
    path = D.folder(spark)
    D.json_lines(spark, sf).orderBy("row_index").select("value").write.text(path)
    return S.read_jsonl(spark, path, 100, 50).select("id", "row_index")


_VALID = f"WITH {_DEFECTS} SELECT id, 'a title' AS title, replace(text, chr(10), ' ') AS abstract, lang AS categories FROM j WHERE lang = 'en' AND text <> ''"


@query(_VALID)
def jsonl_file_scan(spark, sf):
    path = D.folder(spark)
    D.whole_lines(spark, sf).select("value").write.text(path)
    return S.read_papers(spark, path).select("id", "title", "abstract", "categories")


@query(_VALID)
def json_array_scan(spark, sf):
    path = D.folder(spark)
    D.write_arrays(D.whole_lines(spark, sf), path)
    return S.read_papers(spark, path).select("id", "title", "abstract", "categories")


@query(f"WITH {_DEFECTS} SELECT id AS paper_id FROM j WHERE lang = 'en' AND text <> '' AND row_index % 4 <> 0")
def valid_id_scan(spark, sf):
    """Ids of valid papers; every fourth paper has an empty id."""
    path = D.folder(spark)
    D.whole_lines(spark, sf).select(F.when(F.col("row_index") % 4 == 0, F.regexp_replace("value", '"id":"[0-9]+"', '"id":""')).otherwise(F.col("value")).alias("value")).write.text(path)
    return S.valid_ids(spark, path)


@query("SELECT kind, path FROM (VALUES ('jsonl', 'lines'), ('json', 'array'), ('json', 'object')) v(kind, path)")
def format_sniffing(spark, sf):
    path, lines = D.folder(spark), D.whole_lines(spark, sf).select("value")
    lines.write.text(f"{path}/lines")
    lines.limit(2).agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ",\n"), F.lit("]")).alias("value")).write.text(f"{path}/array")
    lines.limit(1).select(F.regexp_replace("value", "^\\{", "{\n").alias("value")).write.text(f"{path}/object")
    return spark.createDataFrame([(S.sniff_format(spark, f"{path}/{p}"), p) for p in ("lines", "array", "object")], "kind string, path string")


@query("SELECT CAST(doc_id AS VARCHAR) AS paper_id FROM documents WHERE doc_id % 5 <> 4")
def fallback_ids(spark, sf):
    path, d = D.folder(spark), D.table(spark, sf, "documents")
    key = F.element_at(F.array(*[F.lit(k) for k in (*S.ID_FIELDS, "other")]), (F.pmod("doc_id", F.lit(5)) + 1).cast("int"))
    d.select(F.to_json(F.map_from_arrays(F.array(key, F.lit("title")), F.array(F.col("doc_id").cast("string"), F.col("text")))).alias("value")).write.text(path)
    return S.ids_of_metadata(spark, path).select("paper_id")


@query("SELECT CAST(doc_id AS VARCHAR) AS id, text AS abstract, doc_id AS row_index, 'hash' AS model FROM documents")
def sidecar_round_trip(spark, sf):
    path, p = D.folder(spark), D.papers(spark, sf)
    info = spark.createDataFrame([("hash", "32")], "model string, embedding_dim string")
    sinks.write_sidecar_parts(p, info, path)
    papers, places, settings = S.sidecar_tables(spark, path)
    model = settings.where("name = 'model'").select(F.col("value").alias("model"))
    each = papers.select(F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.abstract").alias("abstract"))
    return each.join(places, "id").crossJoin(F.broadcast(model)).select("id", "abstract", "row_index", "model")  # one row


@query(f"WITH {_DEFECTS} SELECT count(*) AS total, count(*) FILTER (WHERE lang = 'en' AND text <> '') AS valid, round(count(*) FILTER (WHERE lang = 'en' AND text <> '') * 100.0 / count(*), 6) AS valid_rate FROM j")
def valid_rate(spark, sf):
    return profile.valid_rate(D.json_lines(spark, sf))


@query("SELECT doc_id, text FROM documents ORDER BY md5('0' || text), text, doc_id LIMIT 50")
def sampled_lines(spark, sf):
    d = D.table(spark, sf, "documents").select("doc_id", "text")
    return merge.keep_first(profile.sample_lines(d, 50, "text"), "doc_id").select("doc_id", "text")


@query(f"WITH {_WORDS} SELECT doc_id, CAST(n AS BIGINT) AS length FROM w")
def token_lengths(spark, sf):
    return embed.token_lengths(D.table(spark, sf, "documents").select("doc_id", "text"), "text", embed.WordCounter).select("doc_id", "length")


@query(
    f"""WITH {_WORDS}, s AS (SELECT count(*) AS total, avg(n) AS mean, median(n) AS median, max(n) AS longest, count(*) FILTER (WHERE n <= 512) AS fits FROM w), t AS (SELECT doc_id, text FROM w JOIN documents USING (doc_id) ORDER BY n DESC, doc_id LIMIT 1)
SELECT unnest([0, 1, 2, 3, 4, 5]) AS line, unnest(['texts: ' || total, printf('mean length: %.2f', mean), printf('median length: %.2f', median), printf('longest: %d (at %d)', longest, doc_id), printf('up to 512: %d (%.2f%%)', fits, fits * 100.0 / total), 'longest text: ' || left(text, 2000) || CASE WHEN length(text) > 2000 THEN '...' ELSE '' END]) AS value FROM s CROSS JOIN t"""
)
def length_summary(spark, sf):
    rows = D.table(spark, sf, "documents").select("doc_id", "text", X.word_count(F.col("text")).alias("n"))
    return profile.summary_text(rows, "n", "doc_id", "text", 512)


@query("SELECT CAST(doc_id AS VARCHAR) AS id, 'Abstract: ' || text AS prompted, 'Instruct: Given a question, find papers' || chr(10) || 'Query: ' || text AS instructed FROM documents")
def prompted_text(spark, sf):
    d = D.table(spark, sf, "documents")
    return d.select(F.col("doc_id").cast("string").alias("id"), X.prompted("abstract", F.col("text")).alias("prompted"), X.instruct("Given a question, find papers", F.col("text")).alias("instructed"))


@query("SELECT doc_id, CASE WHEN length(text) > 50 THEN left(text, 47) || '...' ELSE text END AS short, left(replace(text, ' ', '_'), 20) AS stem FROM documents")
def text_shortened(spark, sf):
    return D.table(spark, sf, "documents").select("doc_id", X.shortened_within(F.col("text"), 50).alias("short"), X.file_stem(F.col("text")).alias("stem"))


@query("SELECT CAST(label AS VARCHAR) AS id, max(vec_id) AS value FROM embeddings GROUP BY label")
def metadata_last_wins(spark, sf):
    rows = D.table(spark, sf, "embeddings").select(F.col("label").cast("string").alias("id"), F.col("vec_id").alias("value"), F.col("vec_id").alias("line"))
    return S.last_of_id(rows, "line")


# Merge, reconcile, collect


@query(f"WITH {D.SHARDS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY shard, row_index) AS r FROM shards) SELECT paper_id, shard, row_index FROM n WHERE r = 1")
def merge_keep_first(spark, sf):
    return merge.merge(D.shards(spark, sf)).select("paper_id", "shard", "row_index")


@query(f"WITH {D.SHARDS_SQL} SELECT paper_id, shard, row_index FROM shards")
def merge_keep_all(spark, sf):
    return merge.merge(D.shards(spark, sf), remove_duplicates=False).select("paper_id", "shard", "row_index")


@query(f"WITH {D.SHARDS_SQL} SELECT count(*) AS total, count(DISTINCT paper_id) AS unique_ids, count(*) - count(DISTINCT paper_id) AS duplicates FROM shards")
def merge_duplicate_count(spark, sf):
    return merge.duplicate_count(D.shards(spark, sf))


@query("SELECT doc_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def exact_duplicates_keep_first(spark, sf):
    return merge.keep_first(D.table(spark, sf, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id", "text")


@query("SELECT printf('shard 1: embedding has %d to %d values instead of %d', min(len(embedding)) - 1, max(len(embedding)), max(len(embedding))) AS problem FROM embeddings UNION ALL SELECT 'shard 2: columns [''paper_id'', ''row_index''] instead of [''embedding'', ''paper_id'', ''row_index'']'")
def incompatible_shards(spark, sf):
    first, second = D.shards(spark, sf)
    cut = second.withColumn("embedding", F.when(F.col("row_index") % 7 == 3, F.slice("embedding", F.lit(1), F.size("embedding") - 1)).otherwise(F.col("embedding")))
    return spark.createDataFrame([(p,) for p in merge.incompatibilities([first, cut, first.drop("embedding")])], "problem string")


@query(f"WITH {D.SHARDS_SQL}, u AS (SELECT count(DISTINCT paper_id) AS n FROM shards) SELECT CASE shard WHEN 0 THEN 'first' ELSE 'second' END AS filename, count(*) AS rows, (SELECT count(*) FROM shards) AS total_rows, (SELECT n FROM u) AS merged_rows, (SELECT count(*) FROM shards) - (SELECT n FROM u) AS duplicates FROM shards GROUP BY shard")
def merge_manifest(spark, sf):
    shards, path = D.shards(spark, sf), D.folder(spark)
    merge.merge(shards).write.parquet(path)
    one = merge.manifest(shards, ["first", "second"], merge.assert_equal_lengths(spark.read.parquet(path)))
    return one.select(F.explode("file_details").alias("f"), "merge_info").select("f.filename", "f.rows", "merge_info.total_rows", "merge_info.merged_rows", "merge_info.duplicates")


_IDS = "src AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS paper_id FROM documents), sto AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS paper_id FROM labels)"


@query(f"WITH {_IDS} SELECT paper_id FROM src EXCEPT SELECT paper_id FROM sto")
def missing_ids(spark, sf):
    return reconcile.missing_ids(D.source_ids(spark, sf), D.stored_ids(spark, sf))


@query("SELECT CAST(vec_id * 2 AS VARCHAR) AS paper_id FROM embeddings EXCEPT SELECT CAST(vec_id AS VARCHAR) FROM embeddings")
def extra_ids(spark, sf):
    first, second = D.shards(spark, sf)
    return reconcile.extra_ids(first, second)


@query(f"WITH {_IDS} SELECT paper_id FROM src INTERSECT SELECT paper_id FROM sto")
def common_ids(spark, sf):
    return reconcile.common_ids(D.source_ids(spark, sf), D.stored_ids(spark, sf))


@query(
    f"""WITH {_IDS}, c AS (SELECT (SELECT count(*) FROM src) AS original, (SELECT count(*) FROM sto) AS embedded, (SELECT count(*) FROM (FROM src EXCEPT FROM sto)) AS missing, (SELECT count(*) FROM (FROM sto EXCEPT FROM src)) AS extra, (SELECT count(*) FROM (FROM src INTERSECT FROM sto)) AS common)
SELECT *, printf('%.2f%%', embedded * 100.0 / original) AS success_rate, missing = 0 AND extra = 0 AS same FROM c"""
)
def id_diff_stats(spark, sf):
    return reconcile.id_diff(D.source_ids(spark, sf), D.stored_ids(spark, sf))


@query("SELECT CAST(vec_id AS VARCHAR) AS paper_id, vec_id AS store_position, vec_id + 1 AS metadata_position FROM embeddings WHERE label = 3")
def order_mismatches(spark, sf):
    e = D.table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("paper_id"), F.col("vec_id").alias("row_index"), "label")
    moved = e.select("paper_id", (F.col("row_index") + F.when(F.col("label") == 3, 1).otherwise(0)).alias("row_index"))
    return reconcile.order_mismatches(e.drop("label"), moved)


@query("SELECT DISTINCT CAST(event_id AS VARCHAR) AS paper_id FROM events WHERE event_type = 'error'")
def failed_ids_from_logs(spark, sf):
    return stores.failed_ids(D.log_lines(spark, sf))


@query("SELECT DISTINCT CAST(event_id AS VARCHAR) AS paper_id FROM events WHERE event_type = 'error'")
def log_file_scan(spark, sf):
    path = D.folder(spark)
    D.log_lines(spark, sf).write.text(f"{path}/log")
    return stores.failed_ids(stores.read_logs(spark, [f"{path}/log", f"{path}/missing.log"]))


@query(f"WITH {_IDS}, m AS (SELECT paper_id FROM src EXCEPT SELECT paper_id FROM sto) SELECT paper_id FROM m UNION SELECT CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'error'")
def all_failed_ids(spark, sf):
    return reconcile.all_failed(reconcile.missing_ids(D.source_ids(spark, sf), D.stored_ids(spark, sf)), stores.failed_ids(D.log_lines(spark, sf)))


@query(f"WITH {D.PAPERS_SQL} SELECT id, title, categories FROM papers WHERE row_index NOT IN (SELECT doc_id FROM labels)")
def retry_papers(spark, sf):
    missing = reconcile.missing_ids(D.source_ids(spark, sf), D.stored_ids(spark, sf))
    return reconcile.retry_input(D.papers(spark, sf), missing).select("id", "title", "categories")


@query("SELECT CAST(vec_id AS VARCHAR) AS paper_id FROM embeddings WHERE vec_id >= 96")
def resume_from_batch(spark, sf):
    return reconcile.from_batch(D.corpus(spark, sf), 3, 32).select("paper_id")


_POINTS = f"""WITH {D.PAPERS_SQL}, v AS (SELECT CAST(vec_id * 2 AS VARCHAR) AS paper_id, vec_id AS point_id FROM embeddings)
SELECT point_id, paper_id, title, categories, journal_ref FROM v LEFT JOIN papers ON id = paper_id"""


@query(_POINTS)
def import_payload(spark, sf):
    vectors = D.shards(spark, sf)[1].withColumnRenamed("embedding", "title_embedding")
    p = collection.points(vectors, D.papers(spark, sf), sides=("title",))
    return p.select("point_id", F.col("payload.paper_id").alias("paper_id"), F.col("payload.title").alias("title"), F.col("payload.categories").alias("categories"), F.col("payload.journal_ref").alias("journal_ref"))


@query(f"SELECT * FROM ({_POINTS}) WHERE point_id >= 100 AND point_id < 300")
def import_range(spark, sf):
    vectors = D.shards(spark, sf)[1].withColumnRenamed("embedding", "title_embedding")
    p = collection.points(vectors, D.papers(spark, sf), 100, 200, ("title",))
    return p.select("point_id", F.col("payload.paper_id").alias("paper_id"), F.col("payload.title").alias("title"), F.col("payload.categories").alias("categories"), F.col("payload.journal_ref").alias("journal_ref"))


_UPSERT = """s AS (SELECT vec_id AS point_id, 'old' AS version, label FROM embeddings), n AS (SELECT vec_id * 2 AS point_id, 'new' AS version, label FROM embeddings UNION ALL SELECT vec_id * 2, 'newer', label + 1 FROM embeddings WHERE label < 5),
l AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY version DESC) = 1), u AS (SELECT * FROM s WHERE point_id NOT IN (SELECT point_id FROM l) UNION ALL SELECT * FROM l)"""


def _upsert(spark, sf):
    """Stored points, and new ones with some keys twice."""
    e = D.table(spark, sf, "embeddings")
    twice = e.where("label < 5").select((F.col("vec_id") * 2).alias("point_id"), F.lit("newer").alias("version"), (F.col("label") + 1).alias("label"))
    return e.select(F.col("vec_id").alias("point_id"), F.lit("old").alias("version"), "label"), e.select((F.col("vec_id") * 2).alias("point_id"), F.lit("new").alias("version"), "label").unionAll(twice)


@query(f"WITH {_UPSERT} SELECT * FROM u")
def upsert_points(spark, sf):
    return collection.upserted(*_upsert(spark, sf), order="version")


@query(f"WITH {_UPSERT} SELECT version, count(*) AS n, CAST(sum(point_id) AS BIGINT) AS points, CAST(sum(label) AS BIGINT) AS labels, 'dot' AS metric FROM u GROUP BY version")
def collection_table(spark, sf):
    """A collection that is created, upserted twice, read and dropped; a few sums of it come back."""
    stored, new = _upsert(spark, sf)
    name = f"corvane_points_{uuid.uuid4().hex}"
    collection.create(spark, name, stored, metric="dot")
    collection.upsert(spark, name, stored)
    collection.upsert(spark, name, new, order="version")
    sums = spark.table(name).groupBy("version").agg(F.count(F.lit(1)).alias("n"), F.sum("point_id").alias("points"), F.sum("label").cast("long").alias("labels")).collect()  # a row a version
    rows = [(*r, collection.metric_of(spark, name)) for r in sums]
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(rows, "version string, n bigint, points bigint, labels bigint, metric string")


@query("SELECT vec_id AS point_id, label FROM embeddings WHERE vec_id > 99 ORDER BY vec_id LIMIT 100")
def collection_scroll(spark, sf):
    rows = D.table(spark, sf, "embeddings").select(F.col("vec_id").alias("point_id"), "label")
    store = clustered.Store.create(spark, D.folder(spark), rows, "point_id", width=50)
    store.upsert(rows)
    return store.scroll(100, 99)


@query(f"WITH {_UPSERT} SELECT * FROM u")
def upsert_buckets(spark, sf):
    """Points of two upserts of a clustered store, the second of which has some keys twice."""
    stored, new = _upsert(spark, sf)
    store = clustered.Store.create(spark, D.folder(spark), stored, "point_id", width=100)
    store.upsert(stored)
    store.upsert(new, order="version")
    return store.read()


_PARTS = "a AS (SELECT label AS part, vec_id AS pos, CAST(vec_id AS VARCHAR) AS paper_id FROM embeddings), b AS (SELECT label AS part, vec_id AS pos, CAST(vec_id + CASE WHEN label = 4 THEN 1 ELSE 0 END AS VARCHAR) AS paper_id FROM embeddings)"


def _parts(spark, sf):
    e = D.table(spark, sf, "embeddings")
    part = [F.col("label").alias("part"), F.col("vec_id").alias("pos")]
    moved = F.col("vec_id") + F.when(F.col("label") == 4, 1).otherwise(0)
    return e.select(*part, F.col("vec_id").cast("string").alias("paper_id"), "embedding"), e.select(*part, moved.cast("string").alias("paper_id"), "embedding")


@query(f"WITH {_PARTS} SELECT a.part, pos, a.paper_id FROM a JOIN b USING (part, pos) WHERE a.part NOT IN (SELECT a.part FROM a JOIN b USING (part, pos) WHERE a.paper_id <> b.paper_id)")
def zip_parts(spark, sf):
    return stores.zip_parts(*_parts(spark, sf)).select("part", "pos", "paper_id")


@query(f"WITH {_PARTS} SELECT DISTINCT a.part FROM a JOIN b USING (part, pos) WHERE a.paper_id <> b.paper_id")
def mismatched_parts(spark, sf):
    return stores.mismatched_parts(*_parts(spark, sf))


@query(f"WITH {_PARTS}, {D.QUERY_SQL}, g AS (SELECT a.part, pos, a.paper_id FROM a JOIN b USING (part, pos) WHERE a.part NOT IN (SELECT a.part FROM a JOIN b USING (part, pos) WHERE a.paper_id <> b.paper_id)), s AS (SELECT paper_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), q) AS score FROM g JOIN embeddings ON vec_id = pos CROSS JOIN qv), t AS (SELECT * FROM s ORDER BY score DESC, paper_id LIMIT {K}) SELECT paper_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, paper_id) AS rank FROM t")
def topk_parts(spark, sf):
    return _hits(search.search_parts(*_parts(spark, sf), D.query_vector(spark, sf), K))


@query(f"WITH {D.SHARDS_SQL} SELECT paper_id AS id, max(row_index) AS row_index FROM shards GROUP BY paper_id")
def id_to_index(spark, sf):
    first, second = D.shards(spark, sf)
    return stores.id_to_index(first.unionByName(second))


@query("SELECT CAST(doc_id AS VARCHAR) AS id, title, abstract FROM (SELECT doc_id, split_part(text, chr(10), 1) AS title, text AS abstract FROM documents) WHERE CAST(doc_id AS VARCHAR) IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)")
def papers_of_id_set(spark, sf):
    return S.papers_with_ids(D.papers(spark, sf), D.stored_ids(spark, sf)).select("id", "title", "abstract")


@query(
    f"""WITH {D.CORPUS_SQL}, x AS (SELECT paper_id, label, unnest(range(1, len(t) + 1)) AS dim, unnest(t) AS a, unnest(ab) AS b FROM pv)
SELECT paper_id, CAST(dim AS BIGINT) AS dim, round(CASE WHEN label < 5 THEN b ELSE a END, 6) AS last_token, round(CASE WHEN label < 5 THEN (a + b) / 2 ELSE a END, 6) AS mean FROM x"""
)
def token_pooling(spark, sf):
    c = D.corpus(spark, sf).select("paper_id", F.array("title_embedding", "abstract_embedding").alias("states"), F.array(F.lit(1), F.when(F.col("label") < 5, 1).otherwise(0)).alias("mask"))
    pooled = c.select("paper_id", F.arrays_zip(V.last_token_pool("states", "mask").alias("last"), V.mean_pool("states", "mask").alias("mean")).alias("z"))
    flat = pooled.select("paper_id", F.posexplode("z").alias("dim", "e"))
    return flat.select("paper_id", (F.col("dim") + 1).cast("long").alias("dim"), F.round(F.col("e.last").cast("double"), 6).alias("last_token"), F.round("e.mean", 6).alias("mean"))


@query(f"WITH {D.CORPUS_SQL} SELECT paper_id, round(sqrt(list_sum(list_transform(t, lambda x: x * x))), 6) AS title_norm, round(sqrt(list_sum(list_transform(ab, lambda x: x * x))), 6) AS abstract_norm, round({_PAIR}, 6) AS similarity FROM pv ORDER BY md5(paper_id), paper_id LIMIT 100")
def export_rows(spark, sf):
    return _rounded(sinks.sample_rows(D.corpus(spark, sf)))


@query("SELECT count(*) AS rows, count(DISTINCT vec_id) AS ids, 2 * count(*) AS stored, 2 * count(*) AS positions, 2 * count(*) - 1 AS last FROM embeddings")
def appended_parts(spark, sf):
    """Two appends of part files of bounded size, read back with the places that the files give."""
    path, first = D.folder(spark), D.shards(spark, sf)[0]
    sinks.append_vectors(first.select("paper_id", "embedding"), path, rows_per_file=100)
    sinks.append_vectors(first.select("paper_id", "embedding"), path)
    store = stores.read_store(spark, path)
    return store.agg((F.count(F.lit(1)) / 2).cast("long").alias("rows"), F.count_distinct("paper_id").alias("ids"), F.count(F.lit(1)).alias("stored"), F.count_distinct("row_index").alias("positions"), F.max("row_index").alias("last"))


@query(f"WITH {D.CORPUS_SQL} SELECT paper_id, row_index, round(sqrt(list_sum(list_transform(t, lambda x: x * x))), 6) AS title_norm, round(ab[1], 6) AS abstract_first FROM pv")
def hdf5_slab_scan(spark, sf):
    """Vectors written to HDF5 files in the order of their places, and read back in slabs."""
    path = f"{D.folder(spark)}/store.h5"
    hdf5.write_hdf5(D.corpus(spark, sf).repartitionByRange("row_index").sortWithinPartitions("row_index"), path, dtype="float32", chunk_rows=50).count()
    store = hdf5.read_hdf5(spark, path, slab_rows=100)
    return store.select("paper_id", "row_index", r6(V.norm("title_embedding")).alias("title_norm"), r6(F.get("abstract_embedding", F.lit(0)).cast("double")).alias("abstract_first"))


@query(f"WITH {D.CORPUS_SQL} SELECT paper_id, round(sqrt(list_sum(list_transform(t, lambda x: x * x))), 6) AS norm FROM pv")
def npz_slab_scan(spark, sf):
    """Vectors written to NPZ parts, one a partition, and read back in slabs."""
    path = D.folder(spark)
    D.write_npz(D.corpus(spark, sf).select("paper_id", "title_embedding"), path)
    return npz.read_npz(spark, path, slab_rows=60).select("paper_id", r6(V.norm("embedding")).alias("norm"))


@query("SELECT CAST(vec_id AS VARCHAR) AS paper_id FROM embeddings WHERE label <> 3")
def hdf5_id_scan(spark, sf):
    path = f"{D.folder(spark)}/store.h5"
    hdf5.write_hdf5(D.corpus(spark, sf).where("label <> 3"), path).count()
    return hdf5.read_hdf5(spark, path, sides=()).select("paper_id")


@query("SELECT CAST(vec_id AS VARCHAR) AS paper_id, row_number() OVER (ORDER BY label, CAST(vec_id AS VARCHAR)) + 6 AS row_index FROM embeddings")
def store_positions(spark, sf):
    rows = D.table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("paper_id"), "label")
    return stores.with_positions(rows, "label", start=7, width=2).select("paper_id", "row_index")


@query("SELECT CAST(doc_id AS VARCHAR) AS paper_id FROM labels")
def id_list_files(spark, sf):
    path = D.folder(spark)
    sinks.write_ids(D.stored_ids(spark, sf), path)
    text, csv = spark.read.text(f"{path}/txt").withColumnRenamed("value", "paper_id"), spark.read.option("header", True).csv(f"{path}/csv")
    return text.intersect(csv).intersect(spark.read.schema("paper_id string").json(f"{path}/json"))


@query("SELECT count(*) AS rows, 2 * 64 * 4 * count(*) AS raw_bytes, true AS all_files FROM embeddings")
def storage_sizes(spark, sf):
    """Sizes of a store from its files' own metadata; what compression saves differs from machine to machine and is left out."""
    path = D.folder(spark)
    sinks.append_vectors(D.corpus(spark, sf).select("paper_id", "title_embedding", "abstract_embedding"), path)
    scan = spark.read.parquet(path)
    files = stores.file_sizes(scan).agg((F.sum("rows") == F.sum(F.when(F.col("bytes") > 0, F.col("rows")))).alias("all_files"))
    return stores.storage_report(scan, 64).where("bytes > 0 and ratio > 0").select("rows", "raw_bytes").crossJoin(files)  # one row each


@query("SELECT 'l' || label || '.xlsx' AS workbook, count(*) AS rows FROM embeddings GROUP BY label")
def workbook_rows(spark, sf):
    rows = D.table(spark, sf, "embeddings").select(F.concat(F.lit("l"), F.col("label").cast("string")).alias("file"), F.col("vec_id").alias("id"), V.preview("embedding").cast("string").alias("preview"))
    path = as_path(D.folder(spark))
    return sinks.write_workbooks(rows, path)


@query(_top_sql(_A))
def search_result_file(spark, sf):
    """Hits as a JSON file, read back."""
    path = D.folder(spark)
    sinks.write_json(_hits(search.search(D.corpus(spark, sf), D.query_vector(spark, sf), K, "abstract")), path)
    return spark.read.schema("paper_id string, score double, rank bigint").json(path)


@query("SELECT CAST(doc_id AS VARCHAR) AS id, 'Title: ' || ' ' || split_part(text, chr(10), 1) AS spaced FROM documents")
def prompted_with_separator(spark, sf):
    return D.papers(spark, sf).select("id", X.prompted("title", F.col("title"), " ").alias("spaced"))


@query("SELECT event_id, 'run_' || strftime(ts, '%Y%m%d_%H%M%S') || '.parquet' AS name FROM events")
def run_names(spark, sf):
    return D.table(spark, sf, "events").select("event_id", X.run_name("run", F.col("ts")).alias("name"))


# Sampling

_U = "(CAST('0x' || left(md5(CAST(vec_id AS VARCHAR)), 8) AS BIGINT) + 1) / 4294967297.0::DOUBLE"


def _sample_sql(weight: str, n: int = 50) -> str:
    return f"SELECT vec_id FROM embeddings CROSS JOIN (SELECT count(*) AS n FROM embeddings) m ORDER BY -ln({_U}) / {weight}, vec_id LIMIT {n}"


_EXPONENTIAL, _LINEAR = "exp(-4.0 * (n - 1 - vec_id) / n)", "greatest(0.01, 1.0 - 0.8 * (n - 1 - vec_id) / n)"


def _sampled(spark, sf, strategy: str, n: int = 50) -> DataFrame:
    return sampling.sample(D.table(spark, sf, "embeddings").select("vec_id"), n, strategy, "vec_id")


@query(_sample_sql("1.0"))
def sample_uniform(spark, sf):
    return _sampled(spark, sf, "random")


@query(_sample_sql(_EXPONENTIAL))
def sample_exponential(spark, sf):
    return _sampled(spark, sf, "exponential_decay")


@query(_sample_sql(_LINEAR))
def sample_linear(spark, sf):
    return _sampled(spark, sf, "linear_decay")


@query(
    f"""WITH m AS (SELECT count(*) AS n FROM embeddings) SELECT * FROM (SELECT vec_id FROM embeddings CROSS JOIN m WHERE vec_id < n // 2 ORDER BY {_U}, vec_id LIMIT 10)
UNION ALL SELECT * FROM (SELECT vec_id FROM embeddings CROSS JOIN m WHERE vec_id >= n // 2 ORDER BY {_U}, vec_id LIMIT 40)"""
)
def sample_tail_heavy(spark, sf):
    return _sampled(spark, sf, "tail_heavy")


@query(
    f"""WITH s AS ({_sample_sql(_EXPONENTIAL)}), m AS (SELECT count(*) AS n FROM embeddings), q AS (SELECT unnest([1, 2, 3, 4]) AS quartile, unnest([0, n // 4, n // 2, 3 * n // 4]) AS low, unnest([n // 4, n // 2, 3 * n // 4, n]) - 1 AS high FROM m)
SELECT quartile, CAST(low AS BIGINT) AS low, CAST(high AS BIGINT) AS high, count(vec_id) AS n, round(count(vec_id) * 100.0 / 50, 6) AS percent FROM q LEFT JOIN s ON vec_id BETWEEN low AND high GROUP BY ALL"""
)
def sample_quartiles(spark, sf):
    total = D.table(spark, sf, "embeddings").count()
    return sampling.quartiles(_sampled(spark, sf, "exponential_decay"), total, "vec_id")


@query(f"WITH s AS ({_sample_sql(_EXPONENTIAL)}) SELECT count(*) AS n, round(avg(vec_id), 6) AS mean_position, round(avg(vec_id) / ((SELECT count(*) FROM embeddings) - 1), 6) AS share FROM s")
def sample_mean_position(spark, sf):
    total = D.table(spark, sf, "embeddings").count()
    return _rounded(sampling.mean_position(_sampled(spark, sf, "exponential_decay"), total, "vec_id"))


@query(f"WITH s AS ({_sample_sql(_LINEAR)}), m AS (SELECT count(*) AS n FROM embeddings) SELECT CAST(least(vec_id // greatest(1, n // 20), 19) AS INTEGER) AS bin, count(*) AS n FROM s CROSS JOIN m GROUP BY 1")
def sample_density(spark, sf):
    total = D.table(spark, sf, "embeddings").count()
    return sampling.density(_sampled(spark, sf, "linear_decay"), total, position="vec_id")


@query("SELECT CAST(vec_id AS VARCHAR) AS paper_id FROM embeddings ORDER BY vec_id LIMIT 25")
def sample_sequential(spark, sf):
    return sampling.first_rows(D.corpus(spark, sf), 25).select("paper_id")


@query(
    f"""WITH {D.CORPUS_SQL}, s AS (SELECT {_PAIR} AS c FROM pv)
SELECT count(*) FILTER (WHERE c >= 0.2) AS consistent, count(*) FILTER (WHERE c < 0.2) AS inconsistent, count(*) FILTER (WHERE c IS NULL) AS failed, round(min(c), 6) AS least, round(max(c), 6) AS largest, round(avg(c), 6) AS mean,
 round(quantile_cont(c, 0.5), 6) AS median, round(stddev_pop(c), 6) AS std, round(quantile_cont(c, 0.25), 6) AS p25, round(quantile_cont(c, 0.75), 6) AS p75 FROM s"""
)
def audit_stats(spark, sf):
    pairs = D.corpus(spark, sf).select(V.cosine("title_embedding", "abstract_embedding").alias("similarity"))
    return _rounded(quality.audit(pairs, least=0.2))


@query(f"WITH {D.CORPUS_SQL}, s AS (SELECT avg({_PAIR}) AS mean FROM pv) SELECT round(mean, 6) AS mean, mean > 0.95 AS passed FROM s")
def audit_passes(spark, sf):
    return _rounded(quality.passes(D.corpus(spark, sf).select(V.cosine("title_embedding", "abstract_embedding").alias("similarity"))))


# Manifests, articles, embedding


@query("SELECT printf('pubmed25n%04d.xml.gz', i) AS name, i AS number FROM range(1, 1275) t(i) WHERE i NOT IN (SELECT doc_id FROM labels)")
def download_manifest(spark, sf):
    have = D.table(spark, sf, "labels").select(F.format_string("pubmed25n%04d.xml.gz", "doc_id").alias("name"))
    return stores.download_manifest(spark, have=have)


_SHRED_SQL = "SELECT " + ", ".join(f"{D.ARTICLE_SQL[c]} AS {c}" for c in PUBMED_COLUMNS) + " FROM documents"


@query(_SHRED_SQL)
def pubmed_shred(spark, sf):
    return pubmed.shred(D.articles(spark, sf)).select(*PUBMED_COLUMNS)


@query("SELECT CAST(doc_id AS VARCHAR) AS PMID, '10/' || doc_id AS doi, text || '//' || source AS Abstract, 'D' || doc_id || '/' AS Citatio_doi FROM documents")
def article_files(spark, sf):
    path = D.folder(spark)
    D.articles(spark, sf).select("value").write.option("compression", "gzip").text(path, lineSep="\n\n")
    return pubmed.read_articles(spark, path, strict_ids=True).where("error is null").select("PMID", "doi", "Abstract", "Citatio_doi")


@query("SELECT count(*) FILTER (WHERE source <> 'src7') AS ok, count(*) FILTER (WHERE source = 'src7') AS failed FROM documents")
def article_file_report(spark, sf):
    damaged = D.articles(spark, sf).select(F.when(F.contains("value", F.lit("<Agency>src7</Agency>")), F.replace("value", F.lit("</Agency>"), F.lit("</Agenc>"))).otherwise(F.col("value")).alias("value"))
    path = D.folder(spark)
    damaged.write.text(path)
    report = pubmed.file_report(pubmed.read_articles(spark, path))
    return report.agg(F.sum("ok").alias("ok"), F.sum("failed").alias("failed"))


@query()
def embed_hash(spark, sf):
    return embed.embed_papers(D.papers(spark, sf), lambda: embed.HashEmbedder(32))


@query("SELECT 'hash' AS model, 32 AS embedding_dim, count(*) AS total_papers, CAST(0 AS BIGINT) AS failed_papers, '100.00%' AS success_rate FROM documents")
def embedding_run_info(spark, sf):
    """Counts from the one pass that writes the results."""
    counts = embed.write_results(embed.embed_papers(D.papers(spark, sf), lambda: embed.HashEmbedder(32)), D.folder(spark))
    return sinks.run_info(counts, "hash", 32).select("model", "embedding_dim", "total_papers", "failed_papers", "success_rate")


@query("SELECT CAST(doc_id AS VARCHAR) AS paper_id, 1.0::DOUBLE AS title_similarity, 1.0::DOUBLE AS abstract_similarity FROM documents WHERE text <> '' AND split_part(text, chr(10), 1) <> ''")
def reembedding_audit(spark, sf):
    p = D.papers(spark, sf)
    stored = embed.succeeded(embed.embed_papers(p, lambda: embed.HashEmbedder(32)))
    return embed.reembedded(stored, p, lambda: embed.HashEmbedder(32)).select("paper_id", F.round("title_similarity", 5).alias("title_similarity"), F.round("abstract_similarity", 5).alias("abstract_similarity"))


@query()
def pca_2d(spark, sf):
    return quality.principal_components(D.corpus(spark, sf), "title_embedding")


class _WordLengths:
    """An embedder whose vectors SQL can compute too: the text's length, and how many words it has. Texts without words fail."""

    def __call__(self, text):
        words = text.split(": ", 1)[1].encode().split()
        return [float(len(text)), float(len(words))] if words else None


@query(f"""WITH {D.PAPERS_SQL}, l AS (SELECT id, length('Title: ' || title) AS t, length('Abstract: ' || abstract) AS a, len(regexp_extract_all(title, '[^\\x20\\x09-\\x0D]+')) AS tw, len(regexp_extract_all(abstract, '[^\\x20\\x09-\\x0D]+')) AS aw FROM papers)
SELECT id AS paper_id, CASE WHEN tw = 0 OR aw = 0 THEN NULL ELSE CAST(t AS DOUBLE) END AS title_length, CASE WHEN tw = 0 OR aw = 0 THEN NULL ELSE CAST(aw AS DOUBLE) END AS abstract_words, tw = 0 OR aw = 0 AS failed FROM l""")
def windowed_embedding(spark, sf):
    """Requests in a sliding window of eight, given on in small batches."""
    found = embed.embed_papers(D.papers(spark, sf), _WordLengths, concurrency=8, batch_rows=50)
    return found.select("paper_id", F.get("title_embedding", F.lit(0)).cast("double").alias("title_length"), F.get("abstract_embedding", F.lit(1)).cast("double").alias("abstract_words"), F.col("error").isNotNull().alias("failed"))


class _Declining(embed.HashEmbedder):
    """Declines texts of some lengths, as SQL can tell too."""

    def __call__(self, text):
        return super().__call__(text) if len(text) % 5 else None


@query(f"WITH {_DEFECTS}, v AS (SELECT id, length('Abstract: ' || text) AS a FROM j WHERE lang = 'en' AND text <> '') SELECT id AS paper_id, 'stored' AS state FROM v WHERE a % 5 <> 0 UNION ALL SELECT id, 'failed' FROM v WHERE a % 5 = 0")
def stream_embedding(spark, sf):
    """Files that arrive in two runs of a stream, whose embedder fails for some; the store has dense places, and the counts of both runs add up to it."""
    path = D.folder(spark)
    for turn in (0, 1):
        D.json_lines(spark, sf).where(F.col("row_index") % 2 >= 1 - turn).select("value").write.mode("append").text(f"{path}/in")
        incremental.embed_stream(incremental.paper_stream(spark, f"{path}/in"), f"{path}/store", f"{path}/failed", f"{path}/checkpoint", lambda: _Declining(8)).awaitTermination()
    store = spark.read.parquet(f"{path}/store")
    n, last = store.agg(F.count_distinct("row_index"), F.max("row_index")).first()
    assert n == last + 1 == incremental.runs(spark, f"{path}/failed").agg(F.sum("succeeded")).first()[0]
    failed = incremental.still_failed(spark, f"{path}/store", f"{path}/failed")
    return store.select("paper_id", F.lit("stored").alias("state")).unionAll(failed.select("paper_id", F.lit("failed").alias("state")))


@query(f"WITH {_DEFECTS} SELECT count(*) AS succeeded, CAST(0 AS BIGINT) AS failed, true AS timed FROM j WHERE lang = 'en' AND text <> ''")
def stream_run_counts(spark, sf):
    """What the batches of a stream counted while they were written."""
    path = D.folder(spark)
    D.json_lines(spark, sf).select("value").write.text(f"{path}/in")
    incremental.embed_stream(incremental.paper_stream(spark, f"{path}/in"), f"{path}/store", f"{path}/failed", f"{path}/checkpoint", lambda: embed.HashEmbedder(8), concurrency=2).awaitTermination()
    return incremental.runs(spark, f"{path}/failed").agg(F.sum("succeeded").alias("succeeded"), F.sum("failed").alias("failed"), (F.min("seconds") > 0).alias("timed"))
