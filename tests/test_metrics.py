import numpy as np
import pytest

from panelspark.functions import distributions as D
from panelspark.operators import metrics

Y = [1, 2, 3, 4, 5, 6, 7, 8]
YHAT = [1.1, 2.0, 2.9, 4.2, 4.8, 6.1, 7.0, 7.9]


def _df(spark, y, yhat):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, yhat)], "y_true double, y_pred double")


def test_metric_vector(spark):
    r = metrics.regression_metrics(_df(spark, Y, YHAT), n_features=2, with_pvalue=True).first()
    y, yh = np.array(Y, float), np.array(YHAT, float)
    sse = ((y - yh) ** 2).sum()
    r2 = 1 - sse / ((y - y.mean()) ** 2).sum()
    n, p = 8, 2
    assert r["r2"] == pytest.approx(r2)
    assert r["adj_r2"] == pytest.approx(1 - (1 - r2) * (n - 1) / (n - p - 1))
    assert r["adj_r2"] <= r["r2"]
    f = (r2 / p) / ((1 - r2) / (n - p - 1))
    assert r["f_stat"] == pytest.approx(f) and r["f_stat"] > 0
    jvm = spark.sparkContext._jvm.org.apache.commons.math3.distribution.FDistribution(float(p), float(n - p - 1))
    assert r["f_pvalue"] == pytest.approx(1 - jvm.cumulativeProbability(f), abs=1e-12)
    assert r["rmse"] == pytest.approx(np.sqrt(sse / n)) and r["mae"] == pytest.approx(np.abs(y - yh).mean())
    assert r["n"] == 8 and r["p"] == 2


def test_metric_edge_cases(spark):
    small = metrics.regression_metrics(_df(spark, [1, 2, 3], [1.1, 2.1, 2.7]), n_features=2).first()
    assert small["adj_r2"] is None and small["f_stat"] is None            # n = p + 1
    neg = metrics.regression_metrics(_df(spark, [1, 2, 3, 4, 5], [5, 4, 3, 2, 1]), n_features=1).first()
    assert neg["r2"] < 0 and neg["f_stat"] is None
    perfect = metrics.regression_metrics(_df(spark, [1, 2, 3, 4, 5], [1, 2, 3, 4, 5]), n_features=1).first()
    assert perfect["r2"] == 1.0 and perfect["f_stat"] is None and perfect["rmse"] == 0.0
    const = metrics.regression_metrics(_df(spark, [2, 2, 2], [1, 2, 3]), n_features=0).first()
    assert const["r2"] == 0.0
    const_ok = metrics.regression_metrics(_df(spark, [2, 2, 2], [2, 2, 2]), n_features=0).first()
    assert const_ok["r2"] == 1.0


def test_leaderboard_and_compare(spark):
    m = spark.createDataFrame([("a", 0.5, 1.0), ("b", None, 2.0), ("c", 0.9, 0.5)], "model string, r2 double, rmse double")
    ranked = {r.model: r["rank"] for r in metrics.rank_leaderboard(m).collect()}
    assert ranked == {"c": 1, "a": 2, "b": 3}
    assert metrics.best_model(m).first().model == "c"
    tr = spark.createDataFrame([("a", 0.9, 0.3), ("c", 0.97, 0.2)], "model string, r2 double, rmse double")
    cmp = {r.model: r.status for r in metrics.compare_train_test(tr, m).collect()}
    assert cmp == {"a": "overfit", "c": "moderate"}
    u = metrics.union_results({"x": m.select("model", "r2"), "y": m.select("model", "rmse")})
    assert set(u.columns) == {"model", "r2", "rmse", "source"} and u.count() == 6


@pytest.mark.parametrize("x,d1,d2", [(0.5, 2, 5), (3.0, 4, 20), (12.0, 1, 100)])
def test_tail_functions_match_jvm(spark, x, d1, d2):
    jvm = spark.sparkContext._jvm.org.apache.commons.math3.distribution
    assert D.f_sf(x, d1, d2) == pytest.approx(1 - jvm.FDistribution(float(d1), float(d2)).cumulativeProbability(x), abs=1e-12)
    assert D.t_sf2(x, d2) == pytest.approx(2 * (1 - jvm.TDistribution(float(d2)).cumulativeProbability(x)), abs=1e-12)
    assert D.chi2_sf(x, d1) == pytest.approx(1 - jvm.ChiSquaredDistribution(float(d1)).cumulativeProbability(x), abs=1e-12)


def test_chi2_tail_keeps_relative_precision():
    """Tiny upper tails come straight from the continued fraction, not 1 - P:
    closed forms for k = 2 (exp(-x/2)) and k = 4 ((1 + x/2) exp(-x/2))."""
    import numpy as np

    from panelspark.functions.distributions import chi2_sf
    x = np.array([0.3, 2.0, 9.0, 45.6, 120.0, 400.0, 900.0])
    for k, exact in [(2, np.exp(-x / 2)), (4, (1 + x / 2) * np.exp(-x / 2))]:
        got = chi2_sf(x, k)
        assert np.all(np.abs(got - exact) <= 1e-12 * exact)


def test_metrics_count_complete_rows_only(spark):
    df = spark.createDataFrame([(1.0, 1.5), (3.0, 2.5), (None, 1.0), (9.0, None)], "y_true double, y_pred double")
    r = metrics.regression_metrics(df).first()
    assert r.n == 2 and abs(r.mse - 0.25) < 1e-12 and abs(r.r2 - 0.75) < 1e-12
