import math

import numpy as np
import pandas as pd
import pytest

from panelspark.operators import explore


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200), "t": np.repeat(np.arange(20), 10)})
    pdf.loc[::7, "b"] = np.nan
    return pdf, spark.createDataFrame(pdf)


def test_histogram_matches_numpy(data):
    pdf, df = data
    h = explore.histogram(df, "a", 30, density=True).toPandas().set_index("bin")
    counts, edges = np.histogram(pdf.a, bins=30)
    for i, c in enumerate(counts):
        assert h["count"].get(i, 0) == c
    dens, _ = np.histogram(pdf.a, bins=30, density=True)
    for i, d in enumerate(dens):
        if counts[i]:
            assert h.loc[i, "density"] == pytest.approx(d)


def test_correlation_pairwise_complete(data):
    pdf, df = data
    c = explore.correlation_long(df, ["a", "b"]).toPandas()
    r = c[(c.a == "a") & (c.b == "b")].r.iloc[0]
    assert r == pytest.approx(pdf[["a", "b"]].corr().loc["a", "b"])
    assert len(c) == 4


def test_describe_and_boxplot(data):
    pdf, df = data
    d = explore.describe(df, ["a", "b"]).toPandas().set_index("column")
    pdesc = pdf[["a", "b"]].describe()
    for col in ("a", "b"):
        assert d.loc[col, "count"] == pdesc.loc["count", col]
        assert d.loc[col, "std"] == pytest.approx(pdesc.loc["std", col])
        assert d.loc[col, "q25"] == pytest.approx(pdesc.loc["25%", col])
        assert d.loc[col, "q75"] == pytest.approx(pdesc.loc["75%", col])
    bx = explore.boxplot_stats(df, ["a"]).first()
    q1, q3 = np.quantile(pdf.a, [0.25, 0.75])
    inside = pdf.a[(pdf.a >= q1 - 1.5 * (q3 - q1)) & (pdf.a <= q3 + 1.5 * (q3 - q1))]
    assert bx["whisker_lo"] == pytest.approx(inside.min()) and bx["whisker_hi"] == pytest.approx(inside.max())


def test_kde_matches_formula(data):
    pdf, df = data
    k = explore.kde_grid(df, "a").toPandas().sort_values("i")
    x = pdf.a.to_numpy()
    h = len(x) ** (-0.2) * x.std(ddof=1)
    grid = np.linspace(x.min(), x.max(), 100)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert np.allclose(k.density.to_numpy(), dens)
    flat = explore.kde_grid(df.selectExpr("1.0 as c"), "c")
    assert flat.count() == 0                         # variance below the threshold -> skipped


def test_evolution_and_latest(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 3.0), ("B", 1, 5.0), ("B", 2, 4.0)], "e string, t int, v double")
    y = explore.period_summary(df, "t", "v")
    s = explore.evolution_summary(y, "t").first()
    assert s["first_mean"] == 3.0 and s["last_mean"] == 3.5 and s["total_change"] == 0.5
    lat = {r.e: (r.latest, r.previous, r.trend) for r in explore.latest_delta(df, "e", "t", "v").collect()}
    assert lat == {"A": (3.0, 1.0, "up"), "B": (4.0, 5.0, "down")}
