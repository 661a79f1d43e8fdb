"""Regression metrics and leaderboards.

All metrics are one grouped aggregate (partial + final), so any number of
models x splits x regions is scored in a single pass over the predictions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.distributions import f_pvalue_udf
from panelspark.functions.scalar import CV_GAP_FLAG_ABOVE, classify_overfit


def _lit_or_col(v) -> Column:
    return F.col(v) if isinstance(v, str) else F.lit(v)


def r2_expr(sse: Column, sst: Column) -> Column:
    """R2 with the usual finite convention: constant truth -> 1 if perfect else 0."""
    return F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1 - sse / sst)


def regression_metrics(df: DataFrame, y: str = "y_true", yhat: str = "y_pred", n_features=0,
                       group_cols: Sequence[str] = (), with_pvalue: bool = False) -> DataFrame:
    """N, p, r2, adj_r2, f_stat, [f_pvalue], mse, rmse, mae per group.

    adj_r2 needs n > p+1; F needs also p > 0 and 0 <= r2 < 1 (else NULL).
    ``n_features`` is an int or the name of a column constant within a group.
    Only rows with both values count (n, errors and the variance of the truth alike).
    """
    g = list(group_cols)
    df = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    e = F.col(y) - F.col(yhat)
    pcol = _lit_or_col(n_features)
    agg = df.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(pcol).cast("int").alias("p"),
        F.sum(e * e).alias("sse"),
        F.sum(F.abs(e)).alias("sae"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("sst"))
    n, p = F.col("n"), F.col("p")
    r2 = r2_expr(F.col("sse"), F.col("sst"))
    out = agg.withColumn("r2", r2)
    out = out.withColumn("adj_r2", F.when(n > p + 1, 1 - (1 - F.col("r2")) * (n - 1) / (n - p - 1)))
    ok_f = (p > 0) & (n > p + 1) & (F.col("r2") < 1) & (F.col("r2") >= 0)
    out = out.withColumn("f_stat", F.when(ok_f, (F.col("r2") / p) / ((1 - F.col("r2")) / (n - p - 1))))
    if with_pvalue:
        out = out.withColumn("f_pvalue", F.when(F.col("f_stat").isNotNull(),
                                                f_pvalue_udf(F.col("f_stat"), p.cast("double"),
                                                             (n - p - 1).cast("double"))))
    out = out.withColumn("mse", F.col("sse") / n).withColumn("rmse", F.sqrt(F.col("sse") / n)) \
             .withColumn("mae", F.col("sae") / n)
    return out.drop("sse", "sae", "sst")


def means_by_time(preds: DataFrame, time: str = "time", model: str = "model",
                  y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """Per model and period, mean actual and mean predicted."""
    return preds.groupBy(model, time).agg(F.avg(y).alias("mean_actual"), F.avg(yhat).alias("mean_pred"),
                                          F.count(F.lit(1)).alias("n"))


def best_model(metrics: DataFrame, by: str = "r2", model: str = "model") -> DataFrame:
    """arg max of ``by`` (ties -> smallest model name) as a one-row table."""
    return _best(metrics, by, model)


def _best(metrics: DataFrame, by: str, model: str) -> DataFrame:
    w = Window.orderBy(F.col(by).desc_nulls_last(), F.col(model).asc())
    return metrics.where(F.col(by).isNotNull()).withColumn("__rk", F.row_number().over(w)) \
                  .where("__rk = 1").select(model, by)


def metrics_by_region(preds: DataFrame, best: DataFrame, region: str = "region", model: str = "model",
                      y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """r2, mae, n per region for the best model (empty regions do not appear)."""
    sel = preds.join(F.broadcast(best.select(model)), model, "left_semi")
    m = regression_metrics(sel, y, yhat, 0, [region])
    return m.select(region, "r2", "mae", "n")


def rank_leaderboard(metrics: DataFrame, by: str = "r2", descending: bool = True,
                     model: str = "model") -> DataFrame:
    """Rank 1..n, missing scores last, ties broken by model name.

    A leaderboard holds one row per model (bounded), so the global ordering
    window is cheap.
    """
    order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return metrics.withColumn("rank", F.row_number().over(Window.orderBy(order, F.col(model).asc())))


def compare_train_test(train: DataFrame, test: DataFrame, model: str = "model",
                       metrics: Sequence[str] = ("r2", "rmse")) -> DataFrame:
    """Inner join of two leaderboards, r2 gap and overfit label."""
    a = train.select(model, *[F.col(m).alias(f"{m}_train") for m in metrics])
    b = test.select(model, *[F.col(m).alias(f"{m}_test") for m in metrics])
    j = a.join(b, model)
    if "r2" in metrics:
        j = j.withColumn("r2_gap", F.col("r2_train") - F.col("r2_test")) \
             .withColumn("status", classify_overfit("r2_gap"))
    return j


def cv_overfit_flag(df: DataFrame, train_score: str = "train_score", cv_score: str = "cv_score") -> DataFrame:
    """gap = train - cv, flagged above 0.1 (NULL when never fitted)."""
    gap = F.col(train_score) - F.col(cv_score)
    return df.withColumn("gap", gap).withColumn("overfit", gap > F.lit(CV_GAP_FLAG_ABOVE))


def with_benchmark(models: DataFrame, benchmark: DataFrame, model: str = "model",
                   by: str = "r2") -> DataFrame:
    """Model rows + benchmark row, flags for benchmark and best model."""
    u = models.withColumn("is_benchmark", F.lit(False)) \
              .unionByName(benchmark.withColumn("is_benchmark", F.lit(True)), allowMissingColumns=True)
    best = _best(u, by, model).select(F.col(model).alias("__best"))
    return u.join(F.broadcast(best), F.col(model) == F.col("__best"), "left") \
            .withColumn("is_best", F.col("__best").isNotNull()).drop("__best")


def union_results(tables: Mapping[str, DataFrame], source_col: str = "source") -> DataFrame:
    """Union of result tables with a source tag; missing columns -> NULL."""
    out = None
    for name, t in tables.items():
        t = t.withColumn(source_col, F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def min_errors(metrics: DataFrame) -> DataFrame:
    """Min RMSE and min positive MAE."""
    return metrics.agg(F.min("rmse").alias("min_rmse"),
                       F.min(F.when(F.col("mae") > 0, F.col("mae"))).alias("min_pos_mae"))


def fold_score_summary(scores: DataFrame, group_cols: Sequence[str] = ("model",), score: str = "r2") -> DataFrame:
    """Mean and population std of fold scores."""
    return scores.groupBy(*group_cols).agg(F.avg(score).alias("mean_score"),
                                           F.stddev_pop(score).alias("std_score"),
                                           F.count(F.lit(1)).alias("n_folds"))
