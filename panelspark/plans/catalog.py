"""Imports every query module so the registry is complete.

Chart datasets of the reference (the charts themselves are not drawn) and
the registered queries that produce them:

K1  predicted vs actual + diagonal bounds   predictions_table, pred_vs_actual_bounds
K2  residuals vs predicted, residual hist.  predictions_table (resid), residual_histogram
K3  feature importance bars                 feature_importance, top_features
K4  model comparison with benchmark/best    ml_vs_benchmark, leaderboard_rank, min_errors
K5  correlation heat map                    corr_matrix
K6  target distribution                     histogram, density_histogram
K7  learning curves                         learning_curve, learning_curve_sample
K8  per-period actual vs predicted          actual_vs_pred_by_time
K9  CV score distribution                   cv_scores, cv_score_summary, search_trials
K10 error distribution + density + bias     residual_histogram, error_bias, kde_grid
K11 regional performance                    metrics_by_region, region_classify
K12 global evolution                        yearly_evolution, evolution_summary
K13 regional evolution                      region_year_stats, region_change
K14 home page KPIs, snapshot, bands         kpis, snapshot_bands
K15 explorer timeline, delta                entity_timeline, latest_delta_trend
K16 exploratory page                        describe, corr_matrix, strong_pairs, histogram, boxplot_stats
"""

from __future__ import annotations

from panelspark.plans import registry

_MODULES = ["q_prep", "q_metrics", "q_explore", "q_econ", "q_sources", "q_models"]


def _load():
    import importlib
    for m in _MODULES:
        importlib.import_module(f"panelspark.plans.{m}")


def _shipped(fn):
    def run(spark, sf_dir):
        from panelspark.session import ship_package
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries():
    """Registered builders; each first makes the package importable on the
    executors of the session it is given."""
    _load()
    return {k: _shipped(v) for k, v in registry.QUERIES.items()}


def oracle_sql():
    _load()
    return dict(registry.ORACLE)
