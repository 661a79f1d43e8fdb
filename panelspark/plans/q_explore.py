"""Driver queries for exploration aggregates (D9-D20, D23, E3, B17, B19, F7, K*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import explore
from panelspark.plans.panels import nation_predictions, nation_regions, panel_nation
from panelspark.plans.q_metrics import PRED_SQL
from panelspark.plans.q_prep import _NP_SQL
from panelspark.functions.scalar import scalar_row
from panelspark.plans.registry import query, rnd, rounded

COLS = ["avg_price", "n_orders", "avg_acctbal", "avg_qty", "avg_disc"]
EX_SQL = (f"{_NP_SQL}, ex AS (SELECT np.*, r_name AS region FROM np JOIN nation ON c_nationkey = n_nationkey "
          "JOIN region ON n_regionkey = r_regionkey)")


def _r(cols):
    return ", ".join(f"{rnd(c)} AS {c}" for c in cols)


def ex(spark, sf, *columns):
    return panel_nation(spark, sf, materialize=True, columns=columns).join(
        nation_regions(spark, sf).select("c_nationkey", "region"), "c_nationkey")


@query("yearly_evolution",
       f"WITH {EX_SQL} SELECT quarter, {rnd('sum(avg_price)')} AS total, count(avg_price) AS n, "
       f"{rnd('avg(avg_price)')} AS mean FROM ex GROUP BY quarter")
def q_yearly(spark, sf):
    return rounded(explore.period_summary(ex(spark, sf, "avg_price"), "quarter", "avg_price"))


@query("evolution_summary",
       f"WITH {EX_SQL}, y AS (SELECT quarter, sum(avg_price) AS total, count(avg_price) AS n, avg(avg_price) AS mean "
       "FROM ex GROUP BY quarter) SELECT "
       f"{rnd('avg(mean)')} AS mean_of_means, {rnd('min(mean)')} AS min_mean, {rnd('max(mean)')} AS max_mean, "
       "arg_min(quarter, mean) AS time_of_min, arg_max(quarter, mean) AS time_of_max, "
       f"{rnd('arg_min(mean, quarter)')} AS first_mean, {rnd('arg_max(mean, quarter)')} AS last_mean, "
       f"{rnd('arg_max(mean, quarter) - arg_min(mean, quarter)')} AS total_change, {rnd('avg(n)')} AS mean_count, "
       "min(quarter) AS first_time, max(quarter) AS last_time FROM y")
def q_evolution_summary(spark, sf):
    y = explore.period_summary(ex(spark, sf, "avg_price"), "quarter", "avg_price")
    return rounded(explore.evolution_summary(y, "quarter"))


@query("region_year_stats",
       f"WITH {EX_SQL} SELECT region, quarter, {rnd('avg(avg_price)')} AS mean, {rnd('stddev_samp(avg_price)')} AS std, "
       "count(avg_price) AS n FROM ex GROUP BY region, quarter")
def q_region_year(spark, sf):
    return rounded(explore.group_period_stats(ex(spark, sf, "avg_price"), "region", "quarter", "avg_price"))


@query("region_change",
       f"WITH {EX_SQL}, s AS (SELECT region, quarter, avg(avg_price) AS mean FROM ex GROUP BY region, quarter) "
       f"SELECT region, count(*) AS n_periods, {rnd('arg_min(mean, quarter)')} AS first_mean, "
       f"{rnd('arg_max(mean, quarter)')} AS last_mean, {rnd('arg_max(mean, quarter) - arg_min(mean, quarter)')} AS change "
       "FROM s GROUP BY region HAVING count(*) >= 2")
def q_region_change(spark, sf):
    s = explore.group_period_stats(ex(spark, sf, "avg_price"), "region", "quarter", "avg_price")
    return rounded(explore.group_change(s, "region", "quarter"))


def _corr_sql(where: str = "") -> str:
    parts = []
    for i, a in enumerate(COLS):
        for j, b in enumerate(COLS):
            if i < j:
                parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {i} AS ia, {j} AS ib, corr({a}, {b}) AS r FROM ex")
                parts.append(f"SELECT '{b}', '{a}', {j}, {i}, corr({a}, {b}) FROM ex")
        parts.append(f"SELECT '{a}', '{a}', {i}, {i}, 1.0")
    return (f"WITH {EX_SQL}, c AS ({' UNION ALL '.join(parts)}) "
            f"SELECT a, b, CAST(ia AS INTEGER) AS ia, CAST(ib AS INTEGER) AS ib, {rnd('r')} AS r FROM c {where}")


@query("corr_matrix", _corr_sql())
def q_corr(spark, sf):
    return rounded(explore.correlation_long(ex(spark, sf, *COLS), COLS))


@query("strong_pairs", _corr_sql("WHERE ia < ib AND abs(r) > 0.7"))
def q_strong_pairs(spark, sf):
    return rounded(explore.strong_pairs(explore.correlation_long(ex(spark, sf, *COLS), COLS)))


@query("describe",
       f"WITH {EX_SQL} " + " UNION ALL ".join(
           f"SELECT '{c}' AS \"column\", count({c}) AS count, {rnd(f'avg({c})')} AS mean, "
           f"{rnd(f'stddev_samp({c})')} AS std, {rnd(f'min({c})')} AS min, {rnd(f'max({c})')} AS max, "
           f"{rnd(f'quantile_cont({c}, 0.25)')} AS q25, {rnd(f'quantile_cont({c}, 0.5)')} AS q50, "
           f"{rnd(f'quantile_cont({c}, 0.75)')} AS q75 FROM ex" for c in COLS))
def q_describe(spark, sf):
    return rounded(explore.describe(ex(spark, sf, *COLS), COLS))


def _hist_sql(bins: int, density: bool) -> str:
    d = (f", {rnd('count(*) / (n * w)')} AS density") if density else ""
    return (f"WITH {EX_SQL}, st AS (SELECT min(avg_price) AS lo, max(avg_price) AS hi, count(avg_price) AS n, "
            f"(max(avg_price) - min(avg_price)) / {bins} AS w FROM ex), "
            f"b AS (SELECT CASE WHEN w = 0 THEN 0 ELSE least(CAST(floor((avg_price - lo) / w) AS INTEGER), {bins - 1}) END AS bin, "
            "lo, w, n FROM ex, st WHERE avg_price IS NOT NULL) "
            f"SELECT bin, count(*) AS count, {rnd('lo + bin * w')} AS bin_lo, {rnd('lo + (bin + 1) * w')} AS bin_hi{d} "
            "FROM b GROUP BY bin, lo, w, n")


@query("histogram", _hist_sql(30, False))
def q_histogram(spark, sf):
    return rounded(explore.histogram(ex(spark, sf, "avg_price"), "avg_price", 30))


@query("density_histogram", _hist_sql(50, True))
def q_density_histogram(spark, sf):
    return rounded(explore.histogram(ex(spark, sf, "avg_price"), "avg_price", 50, density=True))


@query("boxplot_stats",
       f"WITH {EX_SQL}, l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM ex" for c in COLS)
       + "), q AS (SELECT \"column\", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
       "quantile_cont(value, 0.75) AS q3 FROM l WHERE value IS NOT NULL GROUP BY 1), "
       "j AS (SELECT l.\"column\", value, q1, median, q3, q3 - q1 AS iqr, "
       "value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS inside FROM l JOIN q USING (\"column\") WHERE value IS NOT NULL) "
       f"SELECT \"column\", {_r(['q1', 'median', 'q3', 'iqr'])}, {rnd('min(CASE WHEN inside THEN value END)')} AS whisker_lo, "
       f"{rnd('max(CASE WHEN inside THEN value END)')} AS whisker_hi, {rnd('avg(value)')} AS mean, "
       "count(CASE WHEN NOT inside THEN 1 END) AS n_outliers, count(*) AS n FROM j GROUP BY 1, q1, median, q3, iqr")
def q_boxplot(spark, sf):
    return rounded(explore.boxplot_stats(ex(spark, sf, *COLS), COLS))


@query("kde_grid",
       f"WITH {EX_SQL}, st AS (SELECT count(avg_price) AS n, stddev_samp(avg_price) AS sd, min(avg_price) AS lo, "
       "max(avg_price) AS hi FROM ex HAVING var_samp(avg_price) > 1e-10), "
       "st2 AS (SELECT *, pow(CAST(n AS DOUBLE), -0.2) * sd AS h, (hi - lo) / 99 AS step FROM st) "
       "SELECT CAST(i AS INTEGER) AS i, " + rnd("lo + i * step") + " AS x, "
       + rnd("sum(exp(-0.5 * ((lo + i * step - avg_price) / h) * ((lo + i * step - avg_price) / h))) / (n * h * sqrt(2 * pi()))")
       + " AS density FROM ex, st2, range(100) t(i) WHERE avg_price IS NOT NULL GROUP BY i, lo, step, n, h")
def q_kde(spark, sf):
    return rounded(explore.kde_grid(ex(spark, sf, "avg_price"), "avg_price"))


@query("kpis",
       f"WITH {EX_SQL} SELECT count(DISTINCT c_nationkey) AS n_entities, min(quarter) AS first_time, "
       "max(quarter) AS last_time, count(*) AS n_rows FROM ex")
def q_kpis(spark, sf):
    return explore.kpis(ex(spark, sf), "c_nationkey", "quarter")


@query("panel_dims",
       f"WITH {EX_SQL} SELECT count(DISTINCT c_nationkey) AS N, count(DISTINCT quarter) AS T, count(*) AS nobs "
       "FROM ex WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in COLS))
def q_panel_dims(spark, sf):
    return explore.panel_dims(ex(spark, sf, *COLS), "c_nationkey", "quarter", COLS)


_Z = "(avg_price - avg(avg_price) OVER ()) / stddev_samp(avg_price) OVER ()"


@query("snapshot_bands",
       f"WITH {EX_SQL}, z AS (SELECT c_nationkey, quarter, {_Z} AS score FROM ex), "
       "s AS (SELECT * FROM z WHERE quarter = (SELECT max(quarter) FROM z)) "
       f"SELECT c_nationkey, quarter, {rnd('score')} AS score, CASE WHEN score < -1.0 THEN 'low' "
       "WHEN score <= 0.5 THEN 'moderate' WHEN score IS NOT NULL THEN 'high' END AS band FROM s")
def q_snapshot_bands(spark, sf):
    e = ex(spark, sf, "avg_price")
    st = scalar_row(e.agg(F.avg("avg_price").alias("__m"), F.stddev_samp("avg_price").alias("__s")))
    z = e.withColumn("score", (F.col("avg_price") - st["__m"]) / st["__s"])
    return rounded(explore.snapshot_bands(z, "c_nationkey", "quarter", "score"))


@query("latest_delta_trend",
       f"WITH {EX_SQL}, w AS (SELECT c_nationkey, quarter, avg_price, "
       "row_number() OVER (PARTITION BY c_nationkey ORDER BY quarter DESC) AS rn, "
       "lead(avg_price) OVER (PARTITION BY c_nationkey ORDER BY quarter DESC) AS previous FROM ex) "
       f"SELECT c_nationkey, quarter AS latest_time, {rnd('avg_price')} AS latest, {rnd('previous')} AS previous, "
       f"{rnd('avg_price - previous')} AS delta, CASE WHEN avg_price - previous > 0 THEN 'up' "
       "WHEN avg_price - previous < 0 THEN 'down' WHEN avg_price - previous = 0 THEN 'flat' END AS trend FROM w WHERE rn = 1")
def q_latest_delta(spark, sf):
    return rounded(explore.latest_delta(ex(spark, sf, "avg_price"), "c_nationkey", "quarter", "avg_price"))


@query("error_bias",
       f"WITH {PRED_SQL} SELECT model, {rnd('avg(y_true - y_pred)')} AS mean_error, "
       f"{rnd('stddev_samp(y_true - y_pred)')} AS std_error FROM preds WHERE split = 'test' GROUP BY model")
def q_error_bias(spark, sf):
    return rounded(explore.mean_bias(nation_predictions(spark, sf).where("split = 'test'")))


@query("residual_histogram",
       f"WITH {PRED_SQL}, r AS (SELECT model, y_true - y_pred AS e FROM preds WHERE split = 'test'), "
       "st AS (SELECT model, min(e) AS lo, (max(e) - min(e)) / 30 AS w FROM r GROUP BY model) "
       "SELECT r.model, CASE WHEN w = 0 THEN 0 ELSE least(CAST(floor((e - lo) / w) AS INTEGER), 29) END AS bin, "
       "count(*) AS n FROM r JOIN st USING (model) GROUP BY 1, 2")
def q_residual_histogram(spark, sf):
    """Per-model residual histogram (bins over each model's own range)."""
    r = nation_predictions(spark, sf).where("split = 'test'").select(
        "model", (F.col("y_true") - F.col("y_pred")).alias("e"))
    st = r.groupBy("model").agg(F.min("e").alias("lo"), ((F.max("e") - F.min("e")) / 30).alias("w"))
    b = F.when(F.col("w") == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("e") - F.col("lo")) / F.col("w")).cast("int"), F.lit(29)))
    return r.join(st, "model").withColumn("bin", b).groupBy("model", "bin").agg(F.count(F.lit(1)).alias("n"))


@query("entity_list", f"WITH {EX_SQL} SELECT DISTINCT c_nationkey FROM ex")
def q_entity_list(spark, sf):
    return explore.distinct_entities(ex(spark, sf), "c_nationkey")


@query("pred_vs_actual_bounds",
       f"WITH {PRED_SQL} SELECT model, {rnd('least(min(y_true), min(y_pred))')} AS lo, "
       f"{rnd('greatest(max(y_true), max(y_pred))')} AS hi, count(*) AS n FROM preds WHERE split = 'test' GROUP BY model")
def q_pred_bounds(spark, sf):
    """K1: diagonal bounds of the predicted-vs-actual scatter per model."""
    p = nation_predictions(spark, sf).where("split = 'test'")
    return rounded(p.groupBy("model").agg(F.least(F.min("y_true"), F.min("y_pred")).alias("lo"),
                                          F.greatest(F.max("y_true"), F.max("y_pred")).alias("hi"),
                                          F.count(F.lit(1)).alias("n")))


