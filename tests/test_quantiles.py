"""Exact quantiles of several columns at once, with ties, NULLs, NaN-free extremes and narrowed brackets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from listing_yield.operators import quantiles


@pytest.mark.parametrize("small,most,grid,margin", [(10_000, 50_000, 64, quantiles.MARGIN), (0, 100, 8, 0.05)])
def test_many_columns_at_once(spark, monkeypatch, small, most, grid, margin):
    monkeypatch.setattr(quantiles, "MARGIN", margin)
    monkeypatch.setattr(quantiles, "SMALL", small)
    monkeypatch.setattr(quantiles, "LIST", most)
    monkeypatch.setattr(quantiles, "GRID", grid)
    rng = np.random.default_rng(5)
    n = 20_000
    g = rng.integers(0, 3, n)
    a = np.round(rng.normal(size=n) * 100, 1)
    b = np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 30, n))  # one value holds a good third
    c = np.where(g == 2, np.nan, np.exp(rng.normal(size=n) * 3))
    rows = [(int(x) if x else None, float(p), float(q), None if np.isnan(r) else float(r))
            for x, p, q, r in zip(g, a, b, c)] + [(9, None, None, None)]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double").repartition(7)
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    wanted = [(F.col("a"), probs), (F.col("b"), probs), (F.col("c"), [0.5]), (F.when(F.col("g") == 1, F.col("a")), [0.5])]
    one = quantiles.quantiles_of(df, wanted).collect()
    assert len(one) == 1
    fine = ~np.isnan(c)
    assert np.allclose([one[0][f"q0_{j}"] for j in range(7)], np.quantile(a, probs), rtol=1e-12)
    assert np.allclose([one[0][f"q1_{j}"] for j in range(7)], np.quantile(b, probs), rtol=1e-12)
    assert np.isclose(one[0].q2_0, np.median(c[fine]), rtol=1e-12) and one[0].n2 == fine.sum()
    assert np.isclose(one[0].q3_0, np.median(a[g == 1]), rtol=1e-12)
    by = {r.g: r for r in quantiles.quantiles_of(df, wanted, ["g"]).collect()}
    assert set(by) == {None, 1, 2}
    for k, r in by.items():
        own = g == (k or 0)
        assert np.allclose([r[f"q0_{j}"] for j in range(7)], np.quantile(a[own], probs), rtol=1e-12)
        assert np.allclose([r[f"q1_{j}"] for j in range(7)], np.quantile(b[own], probs), rtol=1e-12)
        assert (r.n2, r.q2_0) == (0, None) if k == 2 else np.isclose(r.q2_0, np.median(c[own]), rtol=1e-12)
        assert r.n3 == (own.sum() if k == 1 else 0)


def test_no_rows_are_multiplied(spark):
    df = spark.range(100).selectExpr("id % 3 as g", "double(id) as v")
    plan = quantiles.medians(df, {"a": F.col("v"), "b": -F.col("v")}, ["g"])._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Window" not in plan


def test_empty_input(spark):
    df = spark.createDataFrame([], "g int, v double")
    assert quantiles.exact_quantiles(df, "v", [0.5]).count() == 0
    assert quantiles.exact_quantiles(df, "v", [0.5], ["g"]).count() == 0
    nulls = spark.createDataFrame([(1, None)], "g int, v double")
    assert quantiles.medians(nulls, {"m": F.col("v")}, ["g"]).count() == 0
