"""Each registered query of the engine against its SQL twin on the small tables."""

import math
import os

import duckdb
import pytest

from corvane.plans import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(([plain(r[i]) for i in order] for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(list(want.columns), want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_has_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_the_stream_has_failures_too(duck):
    """The embedder of stream_embedding declines some texts; these are rows of its result."""
    found = duck.sql(f"SELECT state, count(*) FROM ({catalog.oracle_sql()['stream_embedding']}) GROUP BY state").fetchall()
    assert {s for s, _ in found} == {"stored", "failed"} and min(n for _, n in found) > 0
