import numpy as np
import pandas as pd
import pytest

from panelspark import session
from panelspark.operators import models


@pytest.fixture(scope="module")
def reg(spark):
    """100 x 5 regression sample, target = 2 f0 + 1.5 f1 + 0.2 noise (seed 42), plus a time column."""
    rng = np.random.default_rng(42)
    X = rng.normal(size=(130, 5))
    y = 2 * X[:, 0] + 1.5 * X[:, 1] + 0.2 * rng.normal(size=130)
    pdf = pd.DataFrame({f"f{i}": X[:, i] for i in range(5)})
    pdf["target"] = y
    pdf["t"] = np.repeat(np.arange(13), 10)
    pdf["k"] = np.arange(130)
    df = spark.createDataFrame(pdf)
    return pdf, df.where("k < 100"), df.where("k >= 100")


FEATS = [f"f{i}" for i in range(5)]


def _cd(X, y, alpha, l1, iters=5000):
    n, k = X.shape
    w = np.zeros(k)
    yc = y - y.mean()
    for _ in range(iters):
        for j in range(k):
            r = yc - X @ w + X[:, j] * w[j]
            rho = X[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1, 0) / ((X[:, j] @ X[:, j]) / n + alpha * (1 - l1))
    return w


@pytest.mark.parametrize("alpha,l1", [(0.1, 0.5), (0.05, 1.0), (0.3, 0.2)])
def test_elastic_net_parity(spark, reg, alpha, l1):
    pdf, train, _ = reg
    m = models.fit("elastic_net", {"alpha": alpha, "l1_ratio": l1, "max_iter": 1000}, train, FEATS, "target")
    tr = pdf[pdf.k < 100]
    X = tr[FEATS].to_numpy()
    Xs = (X - X.mean(axis=0)) / X.std(axis=0)
    w = _cd(Xs, tr.target.to_numpy(), alpha, l1)
    assert np.allclose(m.coefficients, w, atol=2e-4)


@pytest.mark.parametrize("name", ["random_forest", "gradient_boosting", "boosted_trees", "knn", "elastic_net", "svr", "mlp"])
def test_model_contract_and_save_load(spark, reg, name, tmp_path):
    _, train, test = reg
    params = {"random_forest": {"n_estimators": 20, "max_depth": 5, "min_samples_split": 2, "min_samples_leaf": 1,
                                "max_features": "sqrt", "min_impurity_decrease": 0.0},
              "gradient_boosting": {"n_estimators": 20, "learning_rate": 0.1, "max_depth": 3, "min_samples_split": 2,
                                    "min_samples_leaf": 1, "subsample": 1.0, "max_features": 0.7},
              "knn": {"n_neighbors": 5, "p": 2},
              "boosted_trees": {"n_estimators": 20, "max_depth": 3, "learning_rate": 0.2, "subsample": 1.0,
                                "colsample_bytree": 1.0, "gamma": 0.0, "min_child_weight": 1},
              "svr": {"kernel": "rbf", "C": 10.0, "epsilon": 0.05, "gamma": "scale"},
              "mlp": {"hidden_layer_sizes": "20", "activation": "tanh", "alpha": 1e-4,
                      "learning_rate_init": 2e-2, "max_iter": 120},
              "elastic_net": {"alpha": 0.01, "l1_ratio": 0.5, "max_iter": 1000}}[name]
    m = models.fit(name, params, train, FEATS, "target")
    pred = m.predict(test)
    assert pred.count() == 30 and "k" in pred.columns              # keys carried (C5)
    assert models.r2_score(pred, "target") > 0.5
    m.save(str(tmp_path / name))
    back = models.load_fitted(spark, str(tmp_path / name))
    a = sorted((r.k, r.y_pred) for r in m.predict(test).collect())
    b = sorted((r.k, r.y_pred) for r in back.predict(test).collect())
    assert np.allclose([x[1] for x in a], [x[1] for x in b])
    if name in ("random_forest", "gradient_boosting"):
        assert len(m.importances) == 5 and m.importances[0] == max(m.importances)


def test_load_missing_model_raises(spark, tmp_path):
    with pytest.raises(Exception):
        models.load_fitted(spark, str(tmp_path / "nope"))


def test_svr_and_mlp_learn(spark, reg):
    _, train, test = reg
    svr = models.fit("svr", {"kernel": "linear", "C": 10.0, "epsilon": 0.05}, train, FEATS, "target")
    assert models.r2_score(svr.predict(test), "target") > 0.9
    mlp = models.fit("mlp", {"hidden_layer_sizes": "20", "activation": "tanh", "alpha": 1e-4,
                             "learning_rate_init": 1e-2, "max_iter": 300}, train, FEATS, "target", ["k"])
    assert models.r2_score(mlp.predict(test), "target") > 0.8


def test_svr_does_not_depend_on_the_scale_of_the_label(spark, reg):
    from pyspark.sql import functions as F
    _, train, test = reg
    big = [d.withColumn("target", F.col("target") * 1e4 + 5e5) for d in (train, test)]
    svr = models.fit("svr", {"kernel": "linear", "C": 10.0, "epsilon": 0.05}, big[0], FEATS, "target")
    assert svr.state["converged"] and models.r2_score(svr.predict(big[1]), "target") > 0.9


def test_knn_keeps_rows_with_missing_features(spark, reg):
    from pyspark.sql import functions as F
    _, train, test = reg
    m = models.fit("knn", {"n_neighbors": 5, "p": 2}, train, FEATS, "target", ["k"])
    holed = test.withColumn("f0", F.when(F.col("k") % 2 == 0, F.col("f0")))
    got = {r.k: r.y_pred for r in m.predict(holed).collect()}
    assert len(got) == 30 and all((v is None) == (k % 2 == 1) for k, v in got.items())
    again = {r.k: r.y_pred for r in m.predict(holed.repartition(7)).collect()}
    assert again == got


def test_search_falls_back_and_takes_a_splitter(spark, reg):
    from pyspark.sql import functions as F
    _, train, _ = reg
    few = train.where("t < 3")
    res = models.search("elastic_net", few, FEATS, "target", "t", n_trials=2, cv=3, key_cols=["k"])
    assert all(len(t["fold_scores"]) == 3 for t in res.trials)
    own = models.search("elastic_net", train, FEATS, "target", "t", n_trials=2,
                        splitter=lambda d: [(F.col("k") < 60, F.col("k") >= 60)])
    assert all(len(t["fold_scores"]) == 1 for t in own.trials)


def test_registered_family(spark, reg):
    _, train, test = reg
    def mean_model(params, df, features, label, key_cols):
        from pyspark.sql import functions as F
        v = float(df.agg(F.avg(label)).first()[0]) * params["scale"]
        return models.Fitted("mean", params, features, label, lambda d: d.withColumn("y_pred", F.lit(v)))
    models.register_model("mean", mean_model, {"scale": models.FloatP(0.5, 1.5)})
    try:
        res = models.search("mean", train, FEATS, "target", "t", n_trials=2)
        assert 0.5 <= res.best_params["scale"] <= 1.5
        assert models.fit("mean", {"scale": 1.0}, train, FEATS, "target").predict(test).count() == 30
    finally:
        models.REGISTRY.pop("mean")


def test_search_walk_forward_and_pruning(spark, reg):
    _, train, _ = reg
    res = models.search("elastic_net", train, FEATS, "target", "t", n_trials=14, cv=5, n_startup=3, workers=4)
    assert len(res.trials) == 14
    assert res.cv_score == max(t["mean_score"] for t in res.trials if not t["pruned"])
    assert any(t["pruned"] for t in res.trials)
    full = [t for t in res.trials if not t["pruned"]]
    # 10 train periods, min_train = max(5, min(8, max(5, 10 - 5))) = 5 -> 5 folds
    assert all(len(t["fold_scores"]) == 5 for t in full)
    tbl = models.trials_table(spark, res)
    assert tbl.count() == 14


def test_search_space_table(spark):
    t = models.search_space_table(spark).toPandas()
    rf = t[(t.model == "boosted_trees") & (t.parameter == "n_estimators")].iloc[0]
    assert rf["range"] == "50 - 800"
    assert set(t.model) == set(models.SPACES)


def test_train_all_reports_errors(spark, reg):
    _, train, test = reg
    runs = models.train_all(train, test, FEATS, "target", "t", models=["elastic_net", "nonexistent"],
                            fixed_params={"elastic_net": {"alpha": 0.01, "l1_ratio": 0.5},
                                          "nonexistent": {}})
    tbl = {r.model: r for r in models.results_table(spark, runs).collect()}
    assert tbl["nonexistent"].error is not None and tbl["nonexistent"].r2 is None
    assert tbl["elastic_net"].error is None and tbl["elastic_net"].r2 > 0.9
    assert 0 <= tbl["elastic_net"].f_pvalue <= 1


def test_queries_build_the_panel_once(spark, monkeypatch):
    from panelspark.plans import q_models
    built, run_of = [], models.ModelRun
    panel = spark.createDataFrame([(q, 1.0 * q, 1.0, 2.0, 3.0, 4.0) for q in range(20)],
                                  "quarter int, avg_price double, n_orders double, avg_acctbal double, avg_qty double, avg_disc double")
    monkeypatch.setattr(q_models, "panel_nation", lambda *a, **k: built.append(a) or panel)
    monkeypatch.setattr(q_models, "_RUNS", {})
    monkeypatch.setattr(q_models.models, "train_all", lambda train, test, *a, models, **k: [run_of(models[0], None, None, 0.0, None, 0.0)])
    assert [r.model for r in q_models._runs(spark, "x")] == list(models.SPACES)
    assert len(built) == 1
    q_models._runs(spark, "x")
    assert len(built) == 1


@pytest.mark.parametrize("rows_a_task,parts", [(1 << 15, 1), (50, 2), (1, 40)])
def test_model_data_is_dealt_by_its_own_rows(spark, monkeypatch, rows_a_task, parts):
    from panelspark.plans import q_models
    rows = [(n, q, 1.0 * q, 1.0, 2.0, 3.0, 4.0) for n in range(5) for q in range(20)]
    panel = spark.createDataFrame(rows, "c_nationkey int, quarter int, avg_price double, n_orders double, avg_acctbal double, "
                                        "avg_qty double, avg_disc double").repartition(40).localCheckpoint()
    monkeypatch.setattr(q_models, "panel_nation", lambda *a, **k: panel)
    monkeypatch.setattr(q_models, "dealt_by_rows", lambda df: session.dealt_by_rows(df, rows_a_task))
    train, test = q_models.model_data(spark, "x")
    assert train.rdd.getNumPartitions() == test.rdd.getNumPartitions() == parts
    assert sorted(map(tuple, train.union(test).collect())) == sorted(rows)


def test_a_small_panel_is_fitted_without_exchanges(spark):
    rows = spark.range(0, 60, 1, 3).selectExpr("id", "id % 5 AS n", "1.0D * id AS y").repartition(3, "id").localCheckpoint()
    one = spark.createDataFrame(rows.coalesce(1).rdd, rows.schema).localCheckpoint()        # Spark does not know it is one

    def exchanged(df):
        assert df.rdd.getNumPartitions() == 1
        return "hashpartitioning" in session.cut_lineage(df).where("y > 3").groupBy("n").sum("y")._jdf.queryExecution().executedPlan().toString()
    assert exchanged(one) and exchanged(session.dealt_by_rows(one, rows_together=59))
    assert not exchanged(session.dealt_by_rows(one)) and not exchanged(session.dealt_by_rows(rows))


def test_families_are_fitted_at_the_same_time(spark, monkeypatch):
    import threading

    from panelspark.plans import q_models
    met, run_of = threading.Barrier(len(models.SPACES), timeout=60), models.ModelRun
    panel = spark.createDataFrame([(q, 1.0 * q, 1.0, 2.0, 3.0, 4.0) for q in range(20)],
                                  "quarter int, avg_price double, n_orders double, avg_acctbal double, avg_qty double, avg_disc double")
    monkeypatch.setattr(q_models, "panel_nation", lambda *a, **k: panel)
    monkeypatch.setattr(q_models, "_RUNS", {})

    def train_all(train, test, *a, models, **k):
        met.wait()
        return [run_of(models[0], None, None, 0.0, None, 0.0)]
    monkeypatch.setattr(q_models.models, "train_all", train_all)
    assert [r.model for r in q_models._runs(spark, "x")] == list(models.SPACES)


@pytest.mark.parametrize("null_label", [False, True])
def test_boosting_refit_grows_beside_its_folds(spark, monkeypatch, null_label):
    from panelspark.operators import boosting
    rng = np.random.default_rng(5)
    rows = [(i, i // 10, float(rng.normal()), float(rng.normal())) for i in range(120)]
    rows = [(i, t, a, b, None if null_label and i == 7 else 2 * a - b) for i, t, a, b in rows]
    df = spark.createDataFrame(rows, "k int, t int, a double, b double, y double").coalesce(1)
    p = {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 1.0}
    levels, level = [], boosting._level
    monkeypatch.setattr(boosting, "_level", lambda *a: levels.append(1) or level(*a))
    run = models.train_all(df, df.where("t >= 10"), ["a", "b"], "y", "t", models=["boosted_trees"],
                           fixed_params={"boosted_trees": p}, key_cols=["k"])[0]
    assert run.error is None and len(levels) == (12 if null_label else 6)        # 3 trees of 2 levels
    assert run.fold_scores == models.cross_validate("boosted_trees", p, df, ["a", "b"], "y", "t", key_cols=["k"])
    alone = models.fit("boosted_trees", p, df, ["a", "b"], "y", ["k"])
    assert run.fitted.state == alone.state and run.fitted.importances == alone.importances


@pytest.mark.parametrize("name", ["random_forest", "gradient_boosting"])
def test_tree_models_do_not_wrap_their_trees_unasked(spark, tmp_path, name):
    """A fit, its predictions and its importances need no Python object for each tree."""
    df = spark.createDataFrame([(float(i), float(i % 5), float(i % 7 + i // 10)) for i in range(60)], "a double, b double, y double")
    params = {"n_estimators": 7, "max_depth": 3, "min_samples_split": 2, "min_samples_leaf": 1, "max_features": 0.7,
              "min_impurity_decrease": 0.0, "learning_rate": 0.1, "subsample": 0.8}
    m = models.fit(name, params, df, ["a", "b"], "y")
    want = [r["y_pred"] for r in m.predict(df).orderBy("a").collect()]
    last = m.spark_model.stages[-1]
    assert sum(m.importances) == pytest.approx(1.0) and "trees" not in vars(last)
    assert len(last.trees) == 7 and last.trees[0].numNodes > 1
    m.save(str(tmp_path))
    assert [r["y_pred"] for r in models.load_fitted(spark, str(tmp_path)).predict(df).orderBy("a").collect()] == want


def test_folds_run_on_all_cores(spark, monkeypatch):
    """Folds wait for their own jobs, so as many run at a time as there are cores; a number given is kept."""
    df = spark.createDataFrame([(i, i % 9, float(i), float(i % 4)) for i in range(45)], "k long, t int, a double, y double")
    asked, pool = [], models.ThreadPoolExecutor
    monkeypatch.setattr(models, "ThreadPoolExecutor", lambda max_workers: asked.append(max_workers) or pool(max_workers))
    monkeypatch.setattr(spark.sparkContext.__class__, "defaultParallelism", property(lambda self: 7))
    monkeypatch.setattr(models, "fit", lambda *a, **k: models.Fitted("f", {}, ["a"], "y", lambda d: d.withColumn("y_pred", d["y"])))
    first = models.cross_validate("random_forest", {}, df, ["a"], "y", "t")
    assert models.cross_validate("random_forest", {}, df, ["a"], "y", "t", workers=2) == first
    assert asked == [7, 2]


@pytest.mark.parametrize("query", ["cv_fold_scores", "overfit_cv", "search_space", "search_trials", "feature_importance",
                                   "importance_table", "top_features", "model_predictions", "coefficients"])
def test_a_failed_family_is_no_shorter_result(spark, monkeypatch, query):
    """Queries without a column for errors fail with the family's error; only fitted families are kept for the next query."""
    from panelspark.plans import q_models
    from panelspark.plans.registry import QUERIES
    panel = spark.createDataFrame([(n, q, 1.0 * q, 1.0, 2.0, 3.0, 4.0) for n in range(2) for q in range(20)],
                                  "c_nationkey int, quarter int, avg_price double, n_orders double, avg_acctbal double, "
                                  "avg_qty double, avg_disc double")
    trial = {"trial": 0, "params": {}, "fold_scores": [0.5], "mean_score": 0.5, "pruned": False}

    def train_all(train, test, *a, models, **k):
        fitted = q_models.models.Fitted(models[0], {"n": 1}, ["n_orders"], "avg_price", lambda d: d.withColumn("y_pred", d["avg_price"]),
                                        importances=[1.0], coefficients=[1.0])
        found = q_models.models.SearchResult(models[0], {"n": 1}, 0.5, [trial]) if models[0] in q_models.SEARCHED else None
        if models[0] in broken:
            return [run_of(models[0], None, None, None, None, 0.0, "ValueError: no luck")]
        return [run_of(models[0], fitted, found, 0.9, {}, 0.0, fold_scores=None if found else [0.5])]
    run_of, broken = models.ModelRun, {"elastic_net", "svr"}
    monkeypatch.setattr(q_models, "panel_nation", lambda *a, **k: panel)
    monkeypatch.setattr(q_models, "_RUNS", {})
    monkeypatch.setattr(q_models.models, "train_all", train_all)
    with pytest.raises(RuntimeError, match=r"elastic_net \(ValueError: no luck\)"):
        QUERIES[query](spark, "x")
    errors = {r.model: r.error for r in QUERIES["train_all_results"](spark, "x").collect()}
    assert errors == {m: "ValueError: no luck" if m in broken else None for m in models.SPACES}
    broken.clear()
    assert QUERIES[query](spark, "x").count() > 0
