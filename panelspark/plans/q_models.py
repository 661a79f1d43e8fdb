"""Driver queries for models.

Exact KNN on ``embeddings`` has a DuckDB oracle; fitted estimators are
stochastic or iterative, so their queries are rows-only here and are checked
against numpy in the unit tests.  Elastic net and nearest neighbours are searched with
the reference's budget (100 trials on all walk-forward folds); the other families use
fixed, moderate parameters, cross-validated on the same folds.
"""

from __future__ import annotations

import functools
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators import boosting, knn, models
from panelspark.operators.splits import sample_fraction
from panelspark.plans.panels import NATION_FEATURES, NATION_TARGET, panel_nation, table
from panelspark.plans.q_prep import _NP_SQL
from panelspark.plans.registry import query, rnd, rounded
from panelspark.session import cut_lineage, dealt_by_rows

K = 5
FIXED = {
    "random_forest": {"n_estimators": 100, "max_depth": 8, "min_samples_split": 4, "min_samples_leaf": 2,
                      "max_features": 0.7, "min_impurity_decrease": 0.0},
    "boosted_trees": {"n_estimators": 60, "max_depth": 4, "learning_rate": 0.1, "subsample": 0.8,
                      "colsample_bytree": 0.8, "gamma": 0.0, "min_child_weight": 2, "reg_alpha": 1e-8,
                      "reg_lambda": 1.0},
    "svr": {"kernel": "rbf", "C": 10.0, "epsilon": 0.1, "gamma": "scale"},
    "mlp": {"hidden_layer_sizes": "50", "activation": "relu", "alpha": 1e-4, "learning_rate_init": 1e-2,
            "max_iter": 300},
    "gradient_boosting": {"n_estimators": 60, "learning_rate": 0.1, "max_depth": 3, "min_samples_split": 4,
                          "min_samples_leaf": 2, "subsample": 0.8, "max_features": 0.7},
}
_RUNS: dict = {}


def model_data(spark, sf, test_periods: int = 8, complete: bool = True):
    """(train, test) of the nation panel, split at the last ``test_periods``
    quarters of the calendar.  ``complete`` keeps the rows that have the
    target and every feature (B8): models train and score on a panel without
    missing values (a quarter whose orders have no line items has no mean
    quantity or discount).  The panel comes in partitions by its own rows, not by the size of the tables."""
    p = dealt_by_rows(panel_nation(spark, sf, materialize=True))
    cut = p.agg((F.max("quarter") - test_periods + 1).alias("c")).first()["c"]
    if complete:
        p = p.na.drop(subset=NATION_FEATURES + [NATION_TARGET])
    train = p.where(F.col("quarter") < cut)
    test = p.where(F.col("quarter") >= cut)
    return train, test


CURVE = {"alpha": 0.1, "l1_ratio": 0.5, "max_iter": 1000}      # elastic net of the learning curve


def _runs(spark, sf, names=tuple(models.SPACES), data=None):
    """The families' runs, each fitted once per session and table folder (the queries below show sides of one run;
    a failed one is not kept, the next query fits it again); the panel, the only step that reads the tables, is
    built once for all that are still to be fitted, and these are fitted at the same time: their many jobs have a
    task or a few each and would leave most cores idle one by one."""
    key = lambda name: (spark.sparkContext.applicationId, sf, name)
    todo = [name for name in names if key(name) not in _RUNS]
    if todo:
        train, test = data or model_data(spark, sf)

        def run(name):
            return models.train_all(train, test, NATION_FEATURES, NATION_TARGET, "quarter", models=[name],
                                    fixed_params=FIXED, key_cols=["c_nationkey", "quarter"])[0]
        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            new = dict(zip(todo, pool.map(run, todo)))
        _RUNS.update((key(name), done) for name, done in new.items() if done.error is None)
        return [new.get(name) or _RUNS[key(name)] for name in names]
    return [_RUNS[key(name)] for name in names]


def _complete(spark, sf, names=tuple(models.SPACES), data=None):
    """The runs for a query that has no column for errors: a failed family fails the query."""
    return models.complete(_runs(spark, sf, names, data))


def _run(spark, sf, name):
    return _runs(spark, sf, [name])[0]


# ---------------------------------------------------------------- exact KNN on embeddings
_KNN_SQL = (
    "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label AS DOUBLE) AS label FROM embeddings), "
    "d AS (SELECT a.vec_id AS q, b.vec_id AS nb, b.label, list_distance(a.v, b.v) AS dist FROM e a, e b "
    "WHERE a.vec_id <> b.vec_id), "
    f"r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, nb) AS rk FROM d) "
)


def _emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "embedding", F.col("label").cast("double").alias("label"))


@query("knn_neighbors",
       _KNN_SQL + f"SELECT q AS vec_id, nb AS neighbor, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= {K}")
def q_knn_neighbors(spark, sf):
    e = _emb(spark, sf)
    qs = e.select(F.col("vec_id").alias("__q"), "embedding")
    ref = e.select(F.col("vec_id").alias("__r"), "embedding")
    nb = knn.knn_join(qs, ref, "__q", "__r", "embedding", k=K, exclude_self=True)
    return nb.select(F.col("__q").alias("vec_id"), F.col("__r").alias("neighbor"), F.col("rank").cast("int"))


@query("knn_exact",
       _KNN_SQL + f"SELECT q AS vec_id, {rnd('avg(label)')} AS y_pred, count(*) AS n_neighbors FROM r WHERE rk <= {K} GROUP BY q")
def q_knn_exact(spark, sf):
    e = _emb(spark, sf)
    qs = e.select(F.col("vec_id").alias("__q"), "embedding")
    ref = e.select(F.col("vec_id").alias("__r"), "embedding", "label")
    pred = knn.knn_regress(qs, ref, "__q", "__r", "embedding", "label", k=K, exclude_self=True)
    return rounded(pred.select(F.col("__q").alias("vec_id"), "y_pred", "n_neighbors"))


@query("knn_pivots",
       _KNN_SQL + f"SELECT q AS vec_id, nb AS neighbor, CAST(rk AS INTEGER) AS rank FROM r WHERE rk <= {K}")
def q_knn_pivots(spark, sf):
    """The same neighbours through pivots (blocks of 64 rows, as if the table were large)."""
    e = _emb(spark, sf)
    nb = knn.knn_join(e.select(F.col("vec_id").alias("__q"), "embedding"), e.select(F.col("vec_id").alias("__r"), "embedding"),
                      "__q", "__r", "embedding", k=K, exclude_self=True, max_block_bytes=64 * 66 * 8)
    return nb.select(F.col("__q").alias("vec_id"), F.col("__r").alias("neighbor"), F.col("rank").cast("int"))


# ---------------------------------------------------------------- one round of regularised boosting
ROUND = {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.3, "reg_alpha": 5000.0, "reg_lambda": 3.0, "min_child_weight": 20, "gamma": 0.0}
_T = "(sign({0}) * greatest(abs({0}) - 5000.0, 0))"
_STUMP_SQL = (
    "WITH " + _NP_SQL + ", cut AS (SELECT max(quarter) - 8 + 1 AS c FROM np), "
    "tr AS (SELECT np.* FROM np, cut WHERE quarter < c AND " + " AND ".join(f"{x} IS NOT NULL" for x in (*NATION_FEATURES, NATION_TARGET)) + "), "
    f"b AS (SELECT avg({NATION_TARGET}) AS base FROM tr), "
    "long AS (" + " UNION ALL ".join(f"SELECT {i} AS f, '{x}' AS feature, CAST({x} AS DOUBLE) AS x, base - {NATION_TARGET} AS g FROM tr, b"
                                    for i, x in enumerate(NATION_FEATURES)) + "), "
    "v AS (SELECT f, feature, x, sum(g) AS g, count(*) AS h FROM long GROUP BY f, feature, x), "
    "s AS (SELECT f, feature, x, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY f) AS tg, "
    "sum(h) OVER (PARTITION BY f) AS th FROM v WINDOW w AS (PARTITION BY f ORDER BY x)), "
    f"q AS (SELECT *, power({_T.format('gl')}, 2) / (hl + 3.0) + power({_T.format('(tg - gl)')}, 2) / (th - hl + 3.0) "
    f"- power({_T.format('tg')}, 2) / (th + 3.0) AS gain FROM s WHERE hl >= 20 AND th - hl >= 20), "
    "best AS (SELECT * FROM q ORDER BY gain DESC, f, x LIMIT 1), "
    f"m AS (SELECT feature, x AS threshold, gain, base, -{_T.format('gl')} / (hl + 3.0) * 0.3 AS wl, "
    f"-{_T.format('(tg - gl)')} / (th - hl + 3.0) * 0.3 AS wr FROM best, b) ")


def _round(spark, sf):
    train, test = model_data(spark, sf)
    return boosting.fit(train, NATION_FEATURES, NATION_TARGET, ROUND, ["c_nationkey", "quarter"], max_bins=4096), test


@query("boosted_split",
       _STUMP_SQL + f"SELECT feature, {rnd('threshold', 8)} AS threshold, {rnd('gain', 8)} AS gain, {rnd('base', 8)} AS base, "
       f"{rnd('wl', 8)} AS left_weight, {rnd('wr', 8)} AS right_weight FROM m")
def q_boosted_split(spark, sf):
    """The first split with leaf penalties (L1, L2) and least child weight."""
    (e, borders), _ = _round(spark, sf)
    t = e.trees[0]
    row = (NATION_FEATURES[t.feature[0]], float(borders[t.feature[0]][t.bin[0] - 1]), t.gain[0], e.base, t.weight[t.left[0]], t.weight[t.right[0]])
    return rounded(spark.createDataFrame([row], "feature string, threshold double, gain double, base double, left_weight double, "
                                                "right_weight double"), sig=8)


@query("boosted_round",
       _STUMP_SQL + f"SELECT c_nationkey, quarter, {rnd('base + CASE WHEN CASE feature ' + ' '.join(f'WHEN {chr(39)}{x}{chr(39)} THEN {x}' for x in NATION_FEATURES) + ' END <= threshold THEN wl ELSE wr END', 8)} AS y_pred "
       "FROM np, cut, m WHERE quarter >= c AND " + " AND ".join(f"{x} IS NOT NULL" for x in (*NATION_FEATURES, NATION_TARGET)))
def q_boosted_round(spark, sf):
    """Predictions of that one round on the test quarters."""
    (e, borders), test = _round(spark, sf)
    return rounded(boosting.predict(test, NATION_FEATURES, e, borders).select("c_nationkey", "quarter", "y_pred"), sig=8)


# ---------------------------------------------------------------- fitted models (rows-only)
def _model_query(name):
    def q(spark, sf):
        return models.results_table(spark, [_run(spark, sf, name)])
    return q


for _m in models.SPACES:
    query(f"model_{_m}")(_model_query(_m))


@query("train_all_results")
def q_train_all(spark, sf):
    return models.results_table(spark, _runs(spark, sf)).drop("seconds")     # wall time is no result


@query("feature_importance")
def q_importance(spark, sf):
    return models.feature_importance(spark, _complete(spark, sf))


@query("importance_table")
def q_importance_table(spark, sf):
    return models.importance_table(models.feature_importance(spark, _complete(spark, sf)))


@query("coefficients")
def q_coefficients(spark, sf):
    return models.coefficients_table(spark, _complete(spark, sf, ["elastic_net"])[0].fitted)


@query("model_predictions")
def q_model_predictions(spark, sf):
    """Predictions keep the entity and time keys of every test row."""
    data = model_data(spark, sf)
    test = data[1]
    out = None
    for r in _complete(spark, sf, data=data):
        p = r.fitted.predict(test).select(F.lit(r.model).alias("model"), "c_nationkey", "quarter",
                                         F.col(NATION_TARGET).alias("y_true"), "y_pred")
        out = p if out is None else out.unionByName(p)
    return out


@query("search_space")
def q_search_space(spark, sf):
    """I19 + I13: every model's search space, with the value used on the nation panel
    (the best one found where the family is searched) and its CV score."""
    best = spark.createDataFrame([(r.model, k, str(v), r.cv_score) for r in _complete(spark, sf)
                                  for k, v in r.fitted.params.items()],
                                 "model string, parameter string, best_value string, cv_score double")
    return models.search_space_table(spark).join(best, ["model", "parameter"], "left")


SEARCHED = [m for m in models.SPACES if m not in FIXED]


@query("search_trials")
def q_search_trials(spark, sf):
    """All trials of the searched families, with fold scores and pruning."""
    tables = [models.trials_table(spark, r.search) for r in _complete(spark, sf, SEARCHED)]
    return functools.reduce(DataFrame.unionByName, tables)


@query("overfit_cv")
def q_overfit_cv(spark, sf):
    """Train score of the refit against the CV score, and the flag."""
    from panelspark.operators.metrics import cv_overfit_flag
    rows = [(r.model, r.train_score, r.cv_score) for r in _complete(spark, sf)]
    return cv_overfit_flag(spark.createDataFrame(rows, "model string, train_score double, cv_score double"))


@query("cv_fold_scores")
def q_cv_fold_scores(spark, sf):
    """H3: walk-forward R2 of every family by fold (of the best trial where searched)."""
    rows = []
    for r in _complete(spark, sf):
        best = max((t for t in r.search.trials if not t["pruned"]), key=lambda t: t["mean_score"])["fold_scores"] if r.search else r.fold_scores
        rows += [(r.model, i, float(v)) for i, v in enumerate(best or [])]
    return spark.createDataFrame(rows, "model string, fold int, r2 double")


@query("learning_curve")
def q_learning_curve(spark, sf):
    """H6/K7: train and validation R2 for 20..100 % of the train rows, 3 hash folds."""
    train, _ = model_data(spark, sf)
    keyed = cut_lineage(train.withColumn("__fold", F.pmod(F.xxhash64(F.lit(7), "c_nationkey", "quarter"), F.lit(3))))
    rows = []
    for frac in (0.2, 0.4, 0.6, 0.8, 1.0):
        for f in range(3):
            tr = sample_fraction(keyed.where(F.col("__fold") != f), ["c_nationkey", "quarter"], frac)
            va = keyed.where(F.col("__fold") == f)
            m = models.fit("elastic_net", CURVE, tr, NATION_FEATURES, NATION_TARGET)
            rows.append((frac, f, models.r2_score(m.predict(tr), NATION_TARGET),
                         models.r2_score(m.predict(va), NATION_TARGET)))
    df = spark.createDataFrame(rows, "fraction double, fold int, train_r2 double, valid_r2 double")
    return df.groupBy("fraction").agg(F.avg("train_r2").alias("train_mean"), F.stddev_pop("train_r2").alias("train_std"),
                                      F.avg("valid_r2").alias("valid_mean"), F.stddev_pop("valid_r2").alias("valid_std"))



@query("top_features")
def q_top_features(spark, sf):
    """Top-10 features per tree model."""
    return models.top_features(models.feature_importance(spark, _complete(spark, sf)), 10)


_SAVE_SIG = 8


@query("model_save_load",
       "WITH " + _NP_SQL + ", "
       "cut AS (SELECT max(quarter) - 8 + 1 AS c FROM np), "
       "fit AS (SELECT regr_intercept(avg_price, n_orders) AS a, regr_slope(avg_price, n_orders) AS b "
       "FROM np, cut WHERE quarter < c) "
       f"SELECT c_nationkey, quarter, {rnd('a + b * n_orders', _SAVE_SIG)} AS y_pred FROM np, cut, fit WHERE quarter >= c")
def q_model_save_load(spark, sf):
    """A fitted pipeline (assembler + least squares on ``n_orders``)
    is saved to the shared folder, loaded back and used to score the test
    quarters; the reloaded model must predict what the fitted one does."""
    import os
    import uuid

    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from panelspark.session import checkpoint_dir
    from panelspark.sources import sinks

    train, test = model_data(spark, sf, complete=False)     # its only feature, n_orders, is never missing
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["n_orders"], outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol=NATION_TARGET, solver="normal",
                                             regParam=0.0, elasticNetParam=0.0)])
    path = os.path.join(checkpoint_dir(spark), "panelspark-models", uuid.uuid4().hex)
    sinks.save_model(pipe.fit(train), path)
    loaded = sinks.load_model(path)
    pred = loaded.transform(test).select("c_nationkey", "quarter", F.col("prediction").alias("y_pred"))
    return rounded(pred, sig=_SAVE_SIG)
