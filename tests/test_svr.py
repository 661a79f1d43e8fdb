"""Kernel SVR (I6): the optimality conditions of the whole dual, and one block against many."""

import numpy as np
import pandas as pd
import pytest

from panelspark.operators import models, svr

KERNELS = [{"kernel": "linear"}, {"kernel": "rbf", "gamma": 0.4}, {"kernel": "poly", "gamma": 0.5, "degree": 3}]


def data(n=500, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = np.sin(2 * x[:, 0]) + 0.5 * x[:, 1] - 0.2 * x[:, 2] ** 2 + 0.1 * rng.normal(size=n)
    x[-5:], y[-5:] = x[:5], y[:5]                       # repeated rows
    return x, (y - y.mean()) / y.std()


def objective(k, y, beta, eps):
    return 0.5 * beta @ k @ beta - y @ beta + eps * np.abs(beta).sum()


def violation(k, y, beta, c, eps):
    """Greatest breach of the optimality conditions, written out case by case; also the intercept."""
    g = k @ beta - y
    low, high = [], []                                  # bounds of the intercept -b
    for gi, b in zip(g, beta):
        if b < c:
            high.append(gi + (eps if b >= 0 else -eps))
        if b > -c:
            low.append(gi + (eps if b > 0 else -eps))
    return max(low) - min(high), -(max(low) + min(high)) / 2


@pytest.mark.parametrize("kernel", KERNELS, ids=lambda k: k["kernel"])
@pytest.mark.parametrize("c,eps", [(1.0, 0.1), (4.0, 0.05)])
def test_block_solver_is_optimal(kernel, c, eps):
    x, y = data(300)
    k = svr.kernel_matrix(x, x, kernel)
    beta = svr.solve_block(k, -y, np.zeros(len(y)), c, eps, 1e-3)
    assert abs(beta.sum()) < 1e-9 and np.abs(beta).max() <= c + 1e-12
    assert violation(k, y, beta, c, eps)[0] <= 2e-3
    rng = np.random.default_rng(0)
    best = objective(k, y, beta, eps)
    for _ in range(200):                                # no feasible point nearby is better
        other = beta + rng.normal(size=len(beta)) * rng.choice([1e-4, 1e-2, 0.3])
        other = np.clip(other - other.mean(), -c, c)
        if abs(other.sum()) < 1e-9:
            assert objective(k, y, other, eps) >= best - 1e-6


@pytest.mark.parametrize("kernel", KERNELS, ids=lambda k: k["kernel"])
def test_blocks_equal_the_plain_dual(spark, kernel, monkeypatch):
    c, eps, tol = 2.0, 0.1, 1e-2
    x, y = data()
    names = ["x0", "x1", "x2"]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(y=y, id=np.arange(len(y)))).repartition(4)
    vectors, b, info = svr.fit(df, names, kernel, c, eps, tol, block_rows=170)
    assert info["converged"] and info["rounds"] > 1
    got = vectors.toPandas()
    assert abs(got.w.sum()) < 1e-8 and got.w.abs().max() <= c + 1e-12
    k = svr.kernel_matrix(x, x, kernel)
    plain = svr.solve_block(k, -y, np.zeros(len(y)), c, eps, 1e-4)
    pb = violation(k, y, plain, c, eps)[1]
    f = svr.kernel_matrix(x, got[names].to_numpy(), kernel) @ got.w.to_numpy() + b
    assert np.abs(f - (k @ plain + pb)).max() < 0.05
    gv = got[names].to_numpy()
    kv = svr.kernel_matrix(gv, gv, kernel)
    # the same optimal value, although repeated rows may share their weight in another way
    mine = 0.5 * got.w @ kv @ got.w - sum(w * y[np.flatnonzero((x == r).all(1))[0]] for w, r in zip(got.w, gv)) + eps * got.w.abs().sum()
    assert mine == pytest.approx(objective(k, y, plain, eps), abs=0.02 * abs(objective(k, y, plain, eps)))
    # many vectors are dealt in a grid, with the same sums
    few = {r.id: r.s for r in svr.kernel_sums(df, vectors, names, kernel).collect()}
    monkeypatch.setattr(svr, "SEND_BYTES", 0)
    monkeypatch.setattr(svr, "GRID_ROWS", 64)
    grid = {r.id: r.s for r in svr.kernel_sums(df, vectors, names, kernel).collect()}
    assert few.keys() == grid.keys() and all(abs(few[i] - grid[i]) < 1e-9 for i in few)


def test_svr_model_keeps_rows_with_missing_features(spark):
    from pyspark.sql import functions as F
    x, y = data(120)
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=1000 + 50 * y, k=np.arange(120)))
    m = models.fit("svr", {"kernel": "rbf", "C": 5.0, "epsilon": 0.05, "gamma": "scale"}, df, ["a", "b", "c"], "y")
    assert m.state["converged"] and models.r2_score(m.predict(df), "y") > 0.8
    holed = df.withColumn("a", F.when(F.col("k") % 2 == 0, F.col("a")))
    got = {r.k: r.y_pred for r in m.predict(holed).collect()}
    assert len(got) == 120 and all((v is None) == (k % 2 == 1) for k, v in got.items())
