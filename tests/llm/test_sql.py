"""Registered queries against their SQL twins."""

import duckdb
import pytest

from corvane.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(Q.oracle_sql()[name])
    got = Q.queries()[name](spark, SF)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = [list(want.columns).index(c) for c in columns]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(tuple(r[i] for i in order) for r in want.fetchall())


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries()) == list(range(1, 14))
