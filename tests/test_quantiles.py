"""Exact quantiles in rounds, against sorting."""

import numpy as np
import pytest

from corvane.operators import profile, quality
from corvane.operators import quantiles as Q

SHARES = [0, 0.001, 0.25, 0.5, 0.9, 0.95, 0.999, 1]


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(3)


@pytest.mark.parametrize("name", ["normal", "skewed", "ties", "one", "two", "huge"])
@pytest.mark.parametrize("bound,accuracy", [(100_000, 10_000), (20, 50), (1, 200)])
def test_equals_sorting(spark, name, bound, accuracy):
    r = np.random.default_rng(1)
    values = {"normal": r.normal(size=3000), "skewed": np.exp(r.normal(0, 9, 3000)), "ties": r.integers(0, 4, 3000), "one": np.full(500, 7.0), "two": [1.5, -2.0], "huge": np.append(r.normal(size=999), [1e300, -1e300, np.inf])}[name]
    got = Q.exact_quantiles(frame(spark, [*values, None]), "v", SHARES, bound, accuracy)
    places = [s * (len(values) - 1) for s in SHARES]
    held = np.sort(values)
    want = [held[int(np.floor(p))] if held[int(np.floor(p))] == held[int(np.ceil(p))] else held[int(np.floor(p))] + (held[int(np.ceil(p))] - held[int(np.floor(p))]) * (p % 1) for p in places]
    assert got == pytest.approx(want, rel=1e-12)


def test_rounds_fetch_no_more_than_the_bound(spark, monkeypatch):
    fetched, plain = [], Q._at_ranks

    def watched(values, n, ranks, bound, accuracy):
        if ranks and n <= bound:
            fetched.append(n)
        return plain(values, n, ranks, bound, accuracy)

    monkeypatch.setattr(Q, "_at_ranks", watched)
    values = np.random.default_rng(2).normal(size=20_000)
    (median,) = Q.exact_quantiles(frame(spark, values), "v", [0.5], 50, 1000)
    assert median == pytest.approx(np.median(values)) and max(fetched, default=0) <= 50


def test_nothing_nulls_and_no_numbers(spark):
    assert Q.exact_quantiles(frame(spark, []), "v", [0.5, 1]) == [None, None] == Q.exact_quantiles(frame(spark, [None, None]), "v", [0.5, 1])
    got = Q.exact_quantiles(frame(spark, [1, 2, float("nan"), 3] * 50), "v", [0.25, 1], 10, 50)
    assert got[0] == pytest.approx(1.75, abs=0.3) and np.isnan(got[1])
    assert profile.length_stats(frame(spark, []), "v").first()["median"] is None
    assert [r["value"] for r in profile.length_percentiles(frame(spark, [1, 2, 3]), "v", (0, 50, 75)).collect()] == [1.0, 2.0, 2.5]
    assert quality.audit(frame(spark, [0.1, None, 0.3]), "v").select("median", "failed").first().asDict() == {"median": 0.2, "failed": 1}


def test_a_sample_of_a_known_total_is_one_scan(spark):
    from corvane.operators import sampling

    rows = spark.range(100).withColumnRenamed("id", "row_index")
    assert sampling.sample(rows, 10, "linear_decay", total=100).count() == 10
    with pytest.raises(Exception, match="none of a store of 50 rows"):
        sampling.sample(rows, 10, "linear_decay", total=50).collect()
