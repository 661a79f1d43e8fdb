import numpy as np
import pandas as pd
import pytest

from panelspark.functions.quantiles import exact_quantiles, medians_wide


@pytest.mark.parametrize("method", ["exact", "builtin"])
def test_exact_quantiles_match_numpy(spark, method):
    rng = np.random.default_rng(1)
    g = np.repeat(["a", "b", "c"], [1, 7, 400])
    x = rng.normal(size=len(g))
    x[::9] = np.nan
    pdf = pd.DataFrame({"g": g, "x": x, "y": rng.integers(0, 5, len(g)).astype(float)})
    df = spark.createDataFrame(pdf)
    probs = (0.25, 0.5, 0.75)
    got = exact_quantiles(df, ["x", "y"], probs, ["g"], method=method).toPandas()
    for (grp, col, p), v in got.set_index(["g", "column", "prob"])["value"].items():
        vals = pdf.loc[pdf.g == grp, col].dropna().to_numpy()
        assert v == pytest.approx(np.quantile(vals, p), rel=1e-12, abs=1e-12)


def test_exact_quantiles_large_group_uses_bracket(spark):
    # n large enough that the +-m bracket holds many ranks (no fallback path)
    rng = np.random.default_rng(2)
    x = rng.normal(size=60000)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = exact_quantiles(df, ["x"], (0.1, 0.5, 0.9), accuracy=10000, window_limit=1000).toPandas().set_index("prob")["value"]
    for p in (0.1, 0.5, 0.9):
        assert got[p] == pytest.approx(np.quantile(x, p), rel=1e-12)


def test_medians_wide_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    row = medians_wide(df, ["a", "b"]).first()
    assert row["a"] == 2.0 and row["b"] is None


def test_exact_quantiles_distributed_ranking(spark):
    # a tiny window limit forces the range-sort ranking path
    rng = np.random.default_rng(7)
    g = np.repeat(["a", "b"], [30000, 3])
    x = np.round(rng.normal(size=len(g)), 3)          # many ties
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": x}))
    got = exact_quantiles(df, ["x"], (0.1, 0.5, 0.9), ["g"], accuracy=2000, window_limit=50).toPandas()
    for (grp, p), v in got.set_index(["g", "prob"])["value"].items():
        assert v == pytest.approx(np.quantile(x[g == grp], p), rel=1e-12, abs=1e-12)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (float("nan"),)], "v double")
    assert [r.value for r in exact_quantiles(df, ["v"]).collect()] == [1.5]
