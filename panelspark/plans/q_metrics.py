"""Driver queries for metrics, leaderboards and result tables
(D5-D8, D24, E4, C2, F6, G2, G3, I18, B20, B23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import clean, metrics
from panelspark.plans.panels import nation_predictions
from panelspark.plans.q_prep import _NP_SQL
from panelspark.plans.registry import query, rnd, rounded

PRED_SQL = (
    f"{_NP_SQL}, "
    "pp AS (SELECT c_nationkey AS entity, quarter AS time, avg_price AS y, n_orders AS x FROM np), "
    "cc AS (SELECT max(time) - 8 + 1 AS cutoff FROM pp), "
    "ps AS (SELECT pp.*, CASE WHEN time < cutoff THEN 'train' ELSE 'test' END AS split FROM pp, cc), "
    "g AS (SELECT avg(y) AS gm, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM ps WHERE split = 'train'), "
    "em AS (SELECT entity AS em_entity, avg(y) AS em FROM ps WHERE split = 'train' GROUP BY entity), "
    "rg AS (SELECT n_nationkey AS rg_entity, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey), "
    "base AS (SELECT ps.entity, ps.time, ps.split, ps.y, ps.x, lag(ps.y) OVER (PARTITION BY ps.entity ORDER BY ps.time) AS prev, "
    "g.gm, g.a, g.b, em.em, rg.region FROM ps CROSS JOIN g LEFT JOIN em ON ps.entity = em.em_entity "
    "LEFT JOIN rg ON ps.entity = rg.rg_entity), "
    "preds AS ("
    "SELECT 'global_mean' AS model, entity, time, split, region, y AS y_true, gm AS y_pred, 0 AS p FROM base "
    "UNION ALL SELECT 'entity_mean', entity, time, split, region, y, coalesce(em, gm), 0 FROM base "
    "UNION ALL SELECT 'last_value', entity, time, split, region, y, coalesce(prev, em, gm), 1 FROM base "
    "UNION ALL SELECT 'ols_orders', entity, time, split, region, y, a + b * x, 1 FROM base)"
)


def metrics_sql(src: str, groups: list[str], name: str = "mm") -> str:
    """CTE computing the same metrics as ``metrics.regression_metrics``."""
    g = ", ".join(groups)
    sel = (g + ", ") if groups else ""
    return (
        f"{name}_a AS (SELECT {sel}count(*) AS n, CAST(max(p) AS INTEGER) AS p, "
        "sum((y_true - y_pred) * (y_true - y_pred)) AS sse, sum(abs(y_true - y_pred)) AS sae, "
        f"var_pop(y_true) * count(*) AS sst FROM {src}" + (f" GROUP BY {g}" if groups else "") + "), "
        f"{name}_b AS (SELECT *, CASE WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END "
        f"ELSE 1 - sse / sst END AS r2 FROM {name}_a), "
        f"{name} AS (SELECT {sel}n, p, r2, CASE WHEN n > p + 1 THEN 1 - (1 - r2) * (n - 1) / (n - p - 1) END AS adj_r2, "
        "CASE WHEN p > 0 AND n > p + 1 AND r2 < 1 AND r2 >= 0 THEN (r2 / p) / ((1 - r2) / (n - p - 1)) END AS f_stat, "
        f"sse / n AS mse, sqrt(sse / n) AS rmse, sae / n AS mae FROM {name}_b)"
    )


_MCOLS = ["r2", "adj_r2", "f_stat", "mse", "rmse", "mae"]


def _r(cols):
    return ", ".join(f"{rnd(c)} AS {c}" for c in cols)


def _model_metrics(spark, sf):
    return metrics.regression_metrics(nation_predictions(spark, sf), n_features="p", group_cols=["model", "split"])


@query("predictions_table",
       f"WITH {PRED_SQL} SELECT model, entity, time, split, region, {_r(['y_true', 'y_pred'])}, p, "
       f"{rnd('y_true - y_pred')} AS resid FROM preds")
def q_predictions(spark, sf):
    return rounded(clean.add_residual(nation_predictions(spark, sf)))


@query("metrics_by_model",
       f"WITH {PRED_SQL}, {metrics_sql('preds', ['model', 'split'])} SELECT model, split, n, p, {_r(_MCOLS)} FROM mm")
def q_metrics_by_model(spark, sf):
    return rounded(_model_metrics(spark, sf))


_TEST_SQL = f"{PRED_SQL}, {metrics_sql('(SELECT * FROM preds WHERE split = ' + chr(39) + 'test' + chr(39) + ')', ['model'])}"


@query("leaderboard_rank",
       f"WITH {_TEST_SQL} SELECT model, n, p, {_r(_MCOLS)}, "
       "CAST(row_number() OVER (ORDER BY r2 DESC NULLS LAST, model) AS INTEGER) AS rank FROM mm")
def q_leaderboard(spark, sf):
    m = metrics.regression_metrics(nation_predictions(spark, sf).where("split = 'test'"), n_features="p",
                                   group_cols=["model"])
    return rounded(metrics.rank_leaderboard(m).withColumn("rank", F.col("rank").cast("int")))


@query("best_model",
       f"WITH {_TEST_SQL} SELECT model, {rnd('r2')} AS r2 FROM mm ORDER BY r2 DESC, model LIMIT 1")
def q_best_model(spark, sf):
    m = metrics.regression_metrics(nation_predictions(spark, sf).where("split = 'test'"), n_features="p",
                                   group_cols=["model"])
    return rounded(metrics.best_model(m))


@query("metrics_by_region",
       f"WITH {_TEST_SQL}, best AS (SELECT model FROM mm ORDER BY r2 DESC, model LIMIT 1), "
       f"sel AS (SELECT * FROM preds WHERE split = 'test' AND model IN (SELECT model FROM best)), "
       f"{metrics_sql('sel', ['region'], 'rm')} SELECT region, {_r(['r2', 'mae'])}, n FROM rm")
def q_metrics_by_region(spark, sf):
    preds = nation_predictions(spark, sf)
    test = preds.where("split = 'test'")
    m = metrics.regression_metrics(test, n_features="p", group_cols=["model"])
    return rounded(metrics.metrics_by_region(test, metrics.best_model(m)))


@query("actual_vs_pred_by_time",
       f"WITH {PRED_SQL} SELECT model, time, {rnd('avg(y_true)')} AS mean_actual, {rnd('avg(y_pred)')} AS mean_pred, "
       "count(*) AS n FROM preds WHERE split = 'test' GROUP BY model, time")
def q_actual_vs_pred(spark, sf):
    return rounded(metrics.means_by_time(nation_predictions(spark, sf).where("split = 'test'")))


_STATUS = ("CASE WHEN r2_gap < 0.05 THEN 'good' WHEN r2_gap < 0.10 THEN 'moderate' "
           "WHEN r2_gap IS NOT NULL THEN 'overfit' END")


@query("train_test_compare",
       f"WITH {PRED_SQL}, {metrics_sql('preds', ['model', 'split'])}, "
       "j AS (SELECT a.model, a.r2 AS r2_train, a.rmse AS rmse_train, b.r2 AS r2_test, b.rmse AS rmse_test, "
       "a.r2 - b.r2 AS r2_gap FROM mm a JOIN mm b ON a.model = b.model AND a.split = 'train' AND b.split = 'test') "
       f"SELECT model, {_r(['r2_train', 'rmse_train', 'r2_test', 'rmse_test', 'r2_gap'])}, {_STATUS} AS status FROM j")
def q_train_test(spark, sf):
    m = _model_metrics(spark, sf)
    return rounded(metrics.compare_train_test(m.where("split = 'train'"), m.where("split = 'test'")))


@query("ml_vs_benchmark",
       f"WITH {_TEST_SQL}, u AS (SELECT model, r2, rmse, mae, false AS is_benchmark FROM mm WHERE model <> 'entity_mean' "
       "UNION ALL SELECT model, r2, rmse, mae, true FROM mm WHERE model = 'entity_mean'), "
       "best AS (SELECT model AS best FROM u ORDER BY r2 DESC, model LIMIT 1) "
       f"SELECT model, {_r(['r2', 'rmse', 'mae'])}, is_benchmark, best IS NOT NULL AS is_best "
       "FROM u LEFT JOIN best ON u.model = best.best")
def q_ml_vs_benchmark(spark, sf):
    m = metrics.regression_metrics(nation_predictions(spark, sf).where("split = 'test'"), n_features="p",
                                   group_cols=["model"]).select("model", "r2", "rmse", "mae")
    out = metrics.with_benchmark(m.where("model <> 'entity_mean'"), m.where("model = 'entity_mean'"))
    return rounded(out)


@query("results_union",
       f"WITH {PRED_SQL}, {metrics_sql('preds', ['model', 'split'])} "
       f"SELECT model, {_r(['r2', 'rmse', 'mae'])}, NULL::DOUBLE AS adj_r2, 'train' AS source FROM mm WHERE split = 'train' "
       f"UNION ALL SELECT model, {_r(['r2', 'rmse'])}, NULL::DOUBLE, {rnd('adj_r2')}, 'test' FROM mm WHERE split = 'test'")
def q_results_union(spark, sf):
    m = _model_metrics(spark, sf)
    tables = {"train": m.where("split = 'train'").select("model", "r2", "rmse", "mae"),
              "test": m.where("split = 'test'").select("model", "r2", "rmse", "adj_r2")}
    return rounded(metrics.union_results(tables))


@query("min_errors",
       f"WITH {PRED_SQL}, {metrics_sql('preds', ['model', 'split'])} "
       f"SELECT {rnd('min(rmse)')} AS min_rmse, {rnd('min(CASE WHEN mae > 0 THEN mae END)')} AS min_pos_mae FROM mm")
def q_min_errors(spark, sf):
    return rounded(metrics.min_errors(_model_metrics(spark, sf)))


@query("results_sink_roundtrip",
       f"WITH {PRED_SQL}, {metrics_sql('preds', ['model', 'split'])} SELECT model, split, n, p, {_r(_MCOLS)} FROM mm")
def q_results_sink(spark, sf):
    """The metrics table written as a results CSV (header line) into the
    shared folder and read back with its schema; values survive the text
    round trip unchanged."""
    import os
    import uuid

    from panelspark.session import checkpoint_dir
    from panelspark.sources import sinks

    m = rounded(_model_metrics(spark, sf))
    path = os.path.join(checkpoint_dir(spark), "panelspark-results", uuid.uuid4().hex)
    sinks.write_results(m, path, fmt="csv")
    return spark.read.schema(m.schema).option("header", "true").csv(path)
