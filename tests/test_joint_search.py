"""Joint walk-forward scores (I9, H3) against one fit per fold."""

import numpy as np
import pandas as pd
import pytest

from panelspark.operators import joint_search, models

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(11)
    n = 13 * 12
    pdf = pd.DataFrame({"a": rng.normal(50, 3, n), "b": rng.exponential(2, n), "c": 7.0})
    pdf["t"], pdf["k"] = np.arange(n) // 12, np.arange(n)
    pdf["y"] = 1e5 + 30 * pdf.a - 20 * pdf.b + rng.normal(0, 25, n) + 3 * pdf.t
    return pdf, spark.createDataFrame(pdf).repartition(4)


def r2(y, pred):
    return 1 - ((y - pred) ** 2).sum() / ((y - y.mean()) ** 2).sum()


def split(pdf, fold):
    end, lo, hi = fold
    return pdf[pdf.t <= end], pdf[(pdf.t >= lo) & (pdf.t <= hi)]


def scaled(train, other):
    mu, sd = train[FEATS].mean().to_numpy(), train[FEATS].std(ddof=0).to_numpy()
    z = lambda d: np.where(sd > 0, (d[FEATS].to_numpy() - mu) / np.where(sd > 0, sd, 1), 0.0)
    return z(train), z(other)


def test_elastic_net_from_prefix_moments(panel):
    pdf, df = panel
    folds = models.time_folds(df, "t", 8)
    params = [{"alpha": 0.5, "l1_ratio": 0.3, "max_iter": 5000}, {"alpha": 20.0, "l1_ratio": 1.0, "max_iter": 5000}, {"alpha": 1e-4, "l1_ratio": 0.0}]
    got = joint_search.elastic_net_scores(df, FEATS, "y", "t", folds, params)
    for p, scores in zip(params, got):
        for fold, score in zip(folds, scores):
            tr, va = split(pdf, fold)
            x, v = scaled(tr, va)
            y = tr.y.to_numpy()
            w = np.zeros(3)
            for _ in range(3000):                                   # plain coordinate descent on the rows
                for j in range(2):
                    r = y - y.mean() - x @ w + x[:, j] * w[j]
                    rho = x[:, j] @ r / len(y)
                    w[j] = np.sign(rho) * max(abs(rho) - p["alpha"] * p["l1_ratio"], 0) / (1 + p["alpha"] * (1 - p["l1_ratio"]))
            assert score == pytest.approx(r2(va.y.to_numpy(), y.mean() + v @ w), abs=1e-7)


def test_elastic_net_equals_the_spark_fit(panel):
    _, df = panel
    end, lo, hi = fold = models.time_folds(df, "t", 8)[1]
    p = {"alpha": 3.0, "l1_ratio": 0.4, "max_iter": 5000}
    joint = joint_search.elastic_net_scores(df, FEATS, "y", "t", [fold], [p])[0][0]
    m = models.fit("elastic_net", p, df.where(f"t <= {end}"), FEATS, "y")
    assert joint == pytest.approx(models.r2_score(m.predict(df.where(f"t between {lo} and {hi}")), "y"), abs=1e-4)


def test_neighbours_from_one_join_per_fold(panel):
    pdf, df = panel
    folds = models.time_folds(df, "t", 8)[:2]
    params = [{"n_neighbors": k, "p": p} for k, p in ((3, 1), (7, 2), (50, 2), (200, 3))]
    got = joint_search.neighbour_scores(df, FEATS, "y", "t", folds, params, ["k"])
    for q, scores in zip(params, got):
        for fold, score in zip(folds, scores):
            tr, va = split(pdf, fold)
            x, v = scaled(tr, va)
            d = (np.abs(v[:, None, :] - x[None, :, :]) ** q["p"]).sum(2)
            near = np.argsort(d, axis=1)[:, :q["n_neighbors"]]
            assert score == pytest.approx(r2(va.y.to_numpy(), tr.y.to_numpy()[near].mean(1)), abs=1e-7)


def test_search_with_the_full_budget(spark, panel):
    """100 trials; the pruning rule marks the same trials and folds as one fit after the other would."""
    _, df = panel
    res = models.search("elastic_net", df, FEATS, "y", "t", n_trials=100, key_cols=["k"])
    assert len(res.trials) == 100 and any(t["pruned"] for t in res.trials)
    history = []
    for i, t in enumerate(res.trials):
        running = (np.cumsum(t["fold_scores"]) / np.arange(1, len(t["fold_scores"]) + 1)).tolist()
        for j, v in enumerate(running):
            prev = [h[j] for h in history if len(h) > j]
            stop = i >= 10 and prev and v < np.median(prev)
            assert bool(stop) == (t["pruned"] and j == len(running) - 1)
        history.append(running)
    full = [t for t in res.trials if not t["pruned"]]
    assert all(len(t["fold_scores"]) == len(full[0]["fold_scores"]) for t in full)
    assert res.cv_score == max(t["mean_score"] for t in full)
    knn = models.search("knn", df.where("t < 11"), FEATS, "y", "t", n_trials=30, key_cols=["k"])
    assert len(knn.trials) == 30 and 0 < knn.cv_score < 1
