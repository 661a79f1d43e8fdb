"""Driver queries for panel econometrics.

The nation panel is balanced at the correctness scale, so two-way demeaning
has a closed form there and the two-regressor solve is written out in SQL.
Statistics that need distribution tails (p-values) or k x k inverses beyond
2 x 2 are rows-only here and checked against numpy in the unit tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import econ
from panelspark.plans.pipelines import NATION_LAG, NATION_X, NATION_Y, nation_dynamic_panel, nation_lagged_split
from panelspark.plans.q_prep import _NP_SQL
from panelspark.plans.registry import erfc_sql, query, rnd, rounded

SIG = 8   # econometric outputs compared at 8 significant digits

def _demean_sql(rounds: int = 60) -> str:
    """Alternating entity / period demeaning unrolled for ``rounds`` passes
    (exact in one pass for balanced panels, converged to machine precision
    long before 60 passes on the unbalanced ones used here)."""
    parts = ["d0 AS (SELECT entity, time, y AS yd, x1 AS x1d, x2 AS x2d FROM tr)"]
    for i in range(1, rounds + 1):
        parts.append(f"e{i} AS (SELECT entity, time, " + ", ".join(
            f"{v} - avg({v}) OVER (PARTITION BY entity) AS {v}" for v in ("yd", "x1d", "x2d")) + f" FROM d{i - 1})")
        parts.append(f"d{i} AS (SELECT entity, time, " + ", ".join(
            f"{v} - avg({v}) OVER (PARTITION BY time) AS {v}" for v in ("yd", "x1d", "x2d")) + f" FROM e{i})")
    parts.append(f"dm AS (SELECT * FROM d{rounds})")
    return ", ".join(parts) + ", "


_DEMEAN_SQL = _demean_sql()

FE_SQL = (
    f"{_NP_SQL}, "
    "base AS (SELECT c_nationkey AS entity, quarter AS time, avg_price AS y, n_orders AS x1, "
    "lag(avg_price) OVER (PARTITION BY c_nationkey ORDER BY quarter) AS x2 FROM np), "
    "cut AS (SELECT max(time) - 8 + 1 AS cutoff FROM base), "
    "sp AS (SELECT base.*, CASE WHEN time < cutoff THEN 'train' ELSE 'test' END AS split FROM base, cut), "
    "tr AS (SELECT * FROM sp WHERE split = 'train' AND y IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL), "
    + _DEMEAN_SQL +
    "g AS (SELECT sum(x1d * x1d) AS a11, sum(x1d * x2d) AS a12, sum(x2d * x2d) AS a22, "
    "sum(x1d * yd) AS b1, sum(x2d * yd) AS b2 FROM dm), "
    "co AS (SELECT *, a11 * a22 - a12 * a12 AS det, (a22 * b1 - a12 * b2) / (a11 * a22 - a12 * a12) AS c1, "
    "(a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS c2 FROM g)"
)
TERMS = NATION_X + [NATION_LAG]
# the reference's default run fits on the whole panel (S15): same chain without the train filter
FE_FULL_SQL = FE_SQL.replace("WHERE split = 'train' AND y IS NOT NULL", "WHERE y IS NOT NULL")
# entity-clustered covariance of the two slopes (J2), on top of either chain
CLUSTER_SQL = (
    "sc AS (SELECT entity, sum(x1d * (yd - c1 * x1d - c2 * x2d)) AS s1, "
    "sum(x2d * (yd - c1 * x1d - c2 * x2d)) AS s2 FROM dm, co GROUP BY entity), "
    "mt AS (SELECT sum(s1 * s1) AS m11, sum(s1 * s2) AS m12, sum(s2 * s2) AS m22 FROM sc), "
    "v AS (SELECT c1, c2, (a22 * a22 * m11 - 2 * a22 * a12 * m12 + a12 * a12 * m22) / (det * det) AS v11, "
    "(a12 * a12 * m11 - 2 * a11 * a12 * m12 + a11 * a11 * m22) / (det * det) AS v22 FROM co, mt)"
)


def _r(e: str) -> str:
    return rnd(e, sig=SIG)


def _rounded(df):
    return rounded(df, sig=SIG)


@query("panel_lag",
       f"WITH {_NP_SQL}, b AS (SELECT c_nationkey AS entity, quarter AS time, avg_price FROM np) "
       f"SELECT b.entity, b.time, {rnd('b.avg_price')} AS avg_price, "
       f"{rnd('lag(b.avg_price) OVER (PARTITION BY b.entity ORDER BY b.time)')} AS avg_price_lag1, "
       f"{rnd('c.avg_price')} AS avg_price_prev_period FROM b LEFT JOIN b c ON c.entity = b.entity AND c.time = b.time - 1")
def q_panel_lag(spark, sf):
    from panelspark.plans.panels import panel_nation
    p = panel_nation(spark, sf, materialize=True, columns=["avg_price"]).select(F.col("c_nationkey").alias("entity"), F.col("quarter").alias("time"), "avg_price")
    p = econ.add_lag(p, "entity", "time", "avg_price", 1)
    p = econ.add_lag(p, "entity", "time", "avg_price", 1, calendar=True, out="avg_price_prev_period")
    return rounded(p)


@query("within_transform",
       f"WITH {_NP_SQL} SELECT c_nationkey, quarter, "
       + ", ".join(f"{rnd(f'{c} - avg({c}) OVER (PARTITION BY c_nationkey)')} AS {c}_w" for c in ("avg_price", "n_orders"))
       + " FROM np")
def q_within(spark, sf):
    from panelspark.plans.panels import panel_nation
    p = panel_nation(spark, sf, materialize=True, columns=["avg_price", "n_orders"])
    return rounded(econ.within_transform(p, "c_nationkey", ["avg_price", "n_orders"]).drop("avg_price", "n_orders"))


@query("twoway_demean",
       f"WITH {FE_SQL} SELECT entity, time, {rnd('yd', SIG, 4)} AS avg_price, {rnd('x1d', SIG, 4)} AS n_orders, "
       f"{rnd('x2d', SIG, 4)} AS {NATION_LAG} FROM dm")
def q_twoway(spark, sf):
    s = nation_lagged_split(spark, sf).where("split = 'train'").na.drop(subset=[NATION_Y] + TERMS)
    dm, _ = econ.twoway_demean(s, "entity", "time", [NATION_Y] + TERMS)
    return rounded(dm, sig=SIG, max_dec=4)


@query("fe_dynamic_coeffs",
       f"WITH {FE_SQL} SELECT 'n_orders' AS term, {_r('c1')} AS coef FROM co "
       f"UNION ALL SELECT '{NATION_LAG}', {_r('c2')} FROM co")
def q_fe_coeffs(spark, sf):
    fe, _, _ = nation_dynamic_panel(spark, sf)
    return _rounded(fe.coefficients(spark).select("term", "coef"))


@query("fe_clustered_se",
       f"WITH {FE_SQL}, sc AS (SELECT entity, sum(x1d * (yd - c1 * x1d - c2 * x2d)) AS s1, "
       "sum(x2d * (yd - c1 * x1d - c2 * x2d)) AS s2 FROM dm, co GROUP BY entity), "
       "mt AS (SELECT sum(s1 * s1) AS m11, sum(s1 * s2) AS m12, sum(s2 * s2) AS m22 FROM sc), "
       "v AS (SELECT c1, c2, (a22 * a22 * m11 - 2 * a22 * a12 * m12 + a12 * a12 * m22) / (det * det) AS v11, "
       "(a12 * a12 * m11 - 2 * a11 * a12 * m12 + a11 * a11 * m22) / (det * det) AS v22 FROM co, mt) "
       f"SELECT 'n_orders' AS term, {_r('c1')} AS coef, {_r('sqrt(v11)')} AS se, {_r('c1 / sqrt(v11)')} AS t_stat FROM v "
       f"UNION ALL SELECT '{NATION_LAG}', {_r('c2')}, {_r('sqrt(v22)')}, {_r('c2 / sqrt(v22)')} FROM v")
def q_fe_se(spark, sf):
    fe, _, _ = nation_dynamic_panel(spark, sf)
    return _rounded(fe.coefficients(spark).select("term", "coef", "se", "t_stat"))


@query("fe_test_eval",
       f"WITH {FE_SQL}, te AS (SELECT y, c1 * x1 + c2 * x2 AS yhat FROM sp, co WHERE split = 'test' "
       "AND y IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL) "
       f"SELECT count(*) AS n_test, {_r('avg((y - yhat) * (y - yhat))')} AS mse, {_r('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse, "
       f"{_r('avg(abs(y - yhat))')} AS mae, {_r('1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))')} AS r2 FROM te")
def q_fe_test(spark, sf):
    fe, _, test = nation_dynamic_panel(spark, sf)
    return _rounded(econ.evaluate_on_test(fe, test))


@query("nickell_bias",
       f"WITH {FE_SQL}, d AS (SELECT count(DISTINCT entity) AS N, count(DISTINCT time) AS T FROM tr), "
       "nb AS (SELECT N, T, c2 AS a, -(1 + c2) / (T - 1) AS bias FROM d, co) "
       f"SELECT N, T, {_r('a')} AS alpha_ols, {_r('bias')} AS bias, {_r('a - bias')} AS alpha_corrected, "
       f"{_r('abs(bias / a) * 100')} AS bias_percentage, "
       f"{_r('CASE WHEN a > 0 AND a < 1 THEN -ln(2) / ln(a) END')} AS half_life_ols, "
       f"{_r('CASE WHEN a - bias > 0 AND a - bias < 1 THEN -ln(2) / ln(a - bias) END')} AS half_life_corrected, "
       f"{_r('CASE WHEN a - bias > 0 AND a - bias < 1 THEN -ln(2) / ln(a - bias) END - CASE WHEN a > 0 AND a < 1 THEN -ln(2) / ln(a) END')} AS half_life_diff, "
       "CASE WHEN abs(bias / a) * 100 < 5 THEN 'NEGLIGIBLE' WHEN abs(bias / a) * 100 < 15 THEN 'MODERATE' "
       "ELSE 'SEVERE' END AS interpretation FROM nb")
def q_nickell(spark, sf):
    fe, train, _ = nation_dynamic_panel(spark, sf)
    from panelspark.operators.explore import panel_dims
    dims = panel_dims(train, "entity", "time", [NATION_Y] + TERMS).select(
        F.col("N").cast("long").alias("N"), F.col("T").cast("long").alias("T"))
    return _rounded(econ.nickell_bias(fe.coef(NATION_LAG), dims))


@query("ar1_test",
       f"WITH {FE_SQL}, r AS (SELECT entity, time, y - c1 * x1 - c2 * x2 AS e FROM tr, co), "
       "l AS (SELECT e, lag(e) OVER (PARTITION BY entity ORDER BY time) AS el FROM r), "
       "s AS (SELECT count(*) AS m, sum(e * el) AS sel, sum(el * el) AS sll, sum(e * e) AS see FROM l WHERE el IS NOT NULL), "
       "z AS (SELECT m, sel / sll AS rho, sll, greatest(see - 2 * (sel / sll) * sel + (sel / sll) * (sel / sll) * sll, 0) / (m - 1) AS s2 FROM s) "
       f"SELECT {_r('rho')} AS rho, {_r('rho / sqrt(s2 / sll)')} AS t_stat, m AS n FROM z")
def q_ar1(spark, sf):
    fe, _, _ = nation_dynamic_panel(spark, sf)
    out = econ.ar1_test(fe.residuals("raw"), "entity", "time")
    return _rounded(spark.createDataFrame([(out.extra["rho"], out.extra["t_stat"], out.extra["n"])], "rho double, t_stat double, n long"))


@query("persistence",
       f"WITH {FE_SQL}, {CLUSTER_SQL}, pz AS (SELECT c2 AS a, abs(c2 / sqrt(v22)) / sqrt(2) AS zx FROM v), "
       f"pp AS (SELECT a, {erfc_sql('zx')} AS p FROM pz) "
       f"SELECT '{NATION_LAG}' AS term, {_r('a')} AS coefficient, {_r('p')} AS p_value, p < 0.05 AS significant, "
       f"{_r('CASE WHEN a > 0 AND a < 1 THEN -ln(2) / ln(a) END')} AS half_life, "
       "CASE WHEN a > 0 AND a < 1 THEN CASE WHEN a > 0.7 THEN 'STRONG' WHEN a > 0.4 THEN 'MODERATE' ELSE 'WEAK' END "
       "END AS interpretation FROM pp")
def q_persistence(spark, sf):
    """J5 with the entity-clustered standard error (two-sided normal p)."""
    fe, _, _ = nation_dynamic_panel(spark, sf)
    return _rounded(econ.persistence(fe, NATION_LAG, spark))


@query("fe_summary")
def q_fe_summary(spark, sf):
    fe, _, _ = nation_dynamic_panel(spark, sf)
    return fe.summary(spark)


@query("diagnostics")
def q_diagnostics(spark, sf):
    fe, _, _ = nation_dynamic_panel(spark, sf)
    return econ.diagnostics(fe, spark)


@query("fe_full_panel_coeffs",
       f"WITH {FE_FULL_SQL}, {CLUSTER_SQL}, "
       "tz AS (SELECT 'n_orders' AS term, c1 AS b, sqrt(v11) AS s FROM v "
       f"UNION ALL SELECT '{NATION_LAG}', c2, sqrt(v22) FROM v), "
       "tp AS (SELECT term, b, s, abs(b / s) / sqrt(2) AS zx FROM tz) "
       f"SELECT term, {_r('b')} AS coef, {_r('s')} AS se, {_r('b / s')} AS t_stat, {_r(erfc_sql('zx'))} AS p_value FROM tp")
def q_fe_full(spark, sf):
    """The reference's default fits on the whole panel (leaks the test years)."""
    fe, _, _ = nation_dynamic_panel(spark, sf, train_only=False)
    return _rounded(fe.coefficients(spark))


@query("fe_r2",
       f"WITH {FE_SQL}, w AS (SELECT y - avg(y) OVER (PARTITION BY entity) AS yw, x1 - avg(x1) OVER (PARTITION BY entity) AS x1w, "
       "x2 - avg(x2) OVER (PARTITION BY entity) AS x2w, y, x1, x2 FROM tr), "
       "s AS (SELECT sum((yd - c1 * x1d - c2 * x2d) * (yd - c1 * x1d - c2 * x2d)) AS sse, sum(yd * yd) AS sst, count(*) AS n FROM dm, co), "
       "s2 AS (SELECT sum((yw - c1 * x1w - c2 * x2w) * (yw - c1 * x1w - c2 * x2w)) AS ssw, sum(yw * yw) AS stw, "
       "var_pop(y - c1 * x1 - c2 * x2) AS vo, var_pop(y) AS vy FROM w, co) "
       f"SELECT {_r('1 - sse / sst')} AS r2, {_r('1 - ssw / stw')} AS r2_within, {_r('1 - vo / vy')} AS r2_overall, n AS nobs FROM s, s2")
def q_fe_r2(spark, sf):
    """Two-way (model) R2, within (entity-demeaned) R2 and overall R2 with the same slopes."""
    fe, _, _ = nation_dynamic_panel(spark, sf)
    return _rounded(fe.summary(spark).select("r2", "r2_within", "r2_overall", "nobs"))


@query("breusch_pagan",
       f"WITH {FE_SQL}, u AS (SELECT (y - c1 * x1 - c2 * x2) * (y - c1 * x1 - c2 * x2) AS u, x1, x2 FROM tr, co), "
       "c AS (SELECT count(*) AS n, "
       "sum(x1 * x1) - sum(x1) * sum(x1) / count(*) AS s11, sum(x1 * x2) - sum(x1) * sum(x2) / count(*) AS s12, "
       "sum(x2 * x2) - sum(x2) * sum(x2) / count(*) AS s22, sum(x1 * u) - sum(x1) * sum(u) / count(*) AS s1u, "
       "sum(x2 * u) - sum(x2) * sum(u) / count(*) AS s2u, sum(u * u) - sum(u) * sum(u) / count(*) AS suu FROM u), "
       "b AS (SELECT n, suu, (s22 * s1u - s12 * s2u) / (s11 * s22 - s12 * s12) AS b1, "
       "(s11 * s2u - s12 * s1u) / (s11 * s22 - s12 * s12) AS b2, s1u, s2u FROM c), "
       "r AS (SELECT n, (b1 * s1u + b2 * s2u) / suu AS r2 FROM b) "
       f"SELECT {_r('n * r2')} AS lm_stat, {_r('exp(-n * r2 / 2)')} AS lm_pvalue, "
       f"{_r('(r2 / 2) / ((1 - r2) / (n - 3))')} AS f_stat, n FROM r")
def q_breusch_pagan(spark, sf):
    """J10 with k = 2 regressors (the chi-square tail with 2 df is exp(-x/2))."""
    fe, _, _ = nation_dynamic_panel(spark, sf)
    res = fe.residuals("raw")
    out = econ.breusch_pagan(res, fe.terms)
    n = res.count()
    return _rounded(spark.createDataFrame([(out.statistic, out.p_value, out.extra["f_stat"], n)],
                                          "lm_stat double, lm_pvalue double, f_stat double, n long"))


def _solve2(s: str, out: str) -> str:
    """SQL for a 2 x 2 least-squares solve from the sums ``<s>11, <s>12, <s>22,
    <s>y1, <s>y2, <s>yy`` of one row: coefficients, residual sum of squares
    (clipped at 0, as in the solver) and the determinant."""
    det = f"({s}11 * {s}22 - {s}12 * {s}12)"
    b1 = f"(({s}22 * {s}y1 - {s}12 * {s}y2) / {det})"
    b2 = f"(({s}11 * {s}y2 - {s}12 * {s}y1) / {det})"
    return (f"{out} AS (SELECT *, {b1} AS {out}_b1, {b2} AS {out}_b2, {det} AS {out}_det, "
            f"greatest({s}yy - 2 * ({b1} * {s}y1 + {b2} * {s}y2) + {b1} * {b1} * {s}11 "
            f"+ 2 * {b1} * {b2} * {s}12 + {b2} * {b2} * {s}22, 0) AS {out}_sse FROM {out}_in)")


# Random effects (no constant) on the FE sample, every step a 2 x 2 closed form
RE_SQL = (
    f"{FE_SQL}, "
    "gr AS (SELECT count(*) AS n, sum(y * y) AS ryy, sum(y * x1) AS ry1, sum(y * x2) AS ry2, "
    "sum(x1 * x1) AS r11, sum(x1 * x2) AS r12, sum(x2 * x2) AS r22 FROM tr), "
    "en AS (SELECT entity, count(*) AS ni, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2 FROM tr GROUP BY entity), "
    "ge AS (SELECT count(*) AS ne, sum(1.0 / ni) AS sinv, "
    "sum(ni * my * my) AS myy, sum(ni * my * m1) AS my1, sum(ni * my * m2) AS my2, "
    "sum(ni * m1 * m1) AS m11, sum(ni * m1 * m2) AS m12, sum(ni * m2 * m2) AS m22, "
    "sum(my * my) AS uyy, sum(my * m1) AS uy1, sum(my * m2) AS uy2, "
    "sum(m1 * m1) AS u11, sum(m1 * m2) AS u12, sum(m2 * m2) AS u22 FROM en), "
    "wi_in AS (SELECT n, ne, sinv, ryy - myy AS wyy, ry1 - my1 AS wy1, ry2 - my2 AS wy2, "
    "r11 - m11 AS w11, r12 - m12 AS w12, r22 - m22 AS w22, uyy, uy1, uy2, u11, u12, u22 FROM gr, ge), "
    + _solve2("w", "wi") + ", "
    "bt_in AS (SELECT * FROM wi), " + _solve2("u", "bt") + ", "
    "vc AS (SELECT wi_sse / greatest(n - ne - 2, 1) AS s2e, "
    "greatest(0, bt_sse / greatest(ne - 2, 1) - (wi_sse / greatest(n - ne - 2, 1)) / (ne / sinv)) AS s2u FROM bt), "
    "th AS (SELECT en.*, ni * (1 - sqrt(s2e / (ni * s2u + s2e))) * (2 - (1 - sqrt(s2e / (ni * s2u + s2e)))) AS wq "
    "FROM en, vc), "
    "gq AS (SELECT sum(wq * my * my) AS qyy, sum(wq * my * m1) AS qy1, sum(wq * my * m2) AS qy2, "
    "sum(wq * m1 * m1) AS q11, sum(wq * m1 * m2) AS q12, sum(wq * m2 * m2) AS q22 FROM th), "
    "re_in AS (SELECT n, ryy - qyy AS syy, ry1 - qy1 AS sy1, ry2 - qy2 AS sy2, "
    "r11 - q11 AS s11, r12 - q12 AS s12, r22 - q22 AS s22 FROM gr, gq), "
    + _solve2("s", "re") + ", "
    "rv AS (SELECT re_b1, re_b2, re_sse / greatest(n - 2, 1) * s22 / re_det AS rv11, "
    "re_sse / greatest(n - 2, 1) * s11 / re_det AS rv22, -re_sse / greatest(n - 2, 1) * s12 / re_det AS rv12 FROM re)"
)

# Hausman with the unadjusted FE covariance; the chi-square tail with 2 df is exp(-x/2)
HAUSMAN_SQL = (
    f"{RE_SQL}, "
    "fd AS (SELECT count(DISTINCT entity) AS nn, count(DISTINCT time) AS tt, count(*) AS nobs FROM tr), "
    "fy AS (SELECT sum(yd * yd) AS syy FROM dm), "
    "fv AS (SELECT c1, c2, a11, a12, a22, det, greatest(syy - 2 * (c1 * b1 + c2 * b2) + c1 * c1 * a11 "
    "+ 2 * c1 * c2 * a12 + c2 * c2 * a22, 0) / greatest(nobs - 2 - (nn - 1) - (tt - 1), 1) AS f FROM co, fy, fd), "
    "hv AS (SELECT c1 - re_b1 AS d1, c2 - re_b2 AS d2, f * a22 / det - rv11 AS v11, f * a11 / det - rv22 AS v22, "
    "-f * a12 / det - rv12 AS v12 FROM fv, rv), "
    "hs AS (SELECT (v22 * d1 * d1 - 2 * v12 * d1 * d2 + v11 * d2 * d2) / (v11 * v22 - v12 * v12) AS stat FROM hv), "
    "hp AS (SELECT stat, CASE WHEN stat >= 0 THEN exp(-stat / 2) ELSE 1.0 END AS p FROM hs)"
)


def _re_query_sql() -> str:
    return (f"WITH {RE_SQL} SELECT 'n_orders' AS term, {_r('re_b1')} AS coef, {_r('sqrt(rv11)')} AS se FROM rv "
            f"UNION ALL SELECT '{NATION_LAG}', {_r('re_b2')}, {_r('sqrt(rv22)')} FROM rv")


def _hausman_query_sql() -> str:
    return (f"WITH {HAUSMAN_SQL} SELECT 'hausman' AS test, {_r('stat')} AS statistic, "
            f"CAST(2 AS INTEGER) AS df, {_r('p')} AS p_value, "
            "p < 0.05 AS rejected FROM hp")


@query("re_coeffs", _re_query_sql())
def q_re(spark, sf):
    """Random effects (Swamy-Arora variance components, no constant)."""
    fe, _, _ = nation_dynamic_panel(spark, sf)
    re = econ.fit_random_effects(fe.sample, "entity", NATION_Y, TERMS)
    rows = [(t, float(b), float(s)) for t, b, s in zip(TERMS, re.params, re.cov.diagonal() ** 0.5)]
    return _rounded(spark.createDataFrame(rows, "term string, coef double, se double"))


@query("hausman", _hausman_query_sql())
def q_hausman(spark, sf):
    """FE (two-way, unadjusted) vs RE (Swamy-Arora) Hausman statistic."""
    fe, _, _ = nation_dynamic_panel(spark, sf)
    h = econ.hausman(fe, econ.fit_random_effects(fe.sample, "entity", NATION_Y, TERMS))
    return _rounded(spark.createDataFrame([(h.name, h.statistic, h.extra["df"], h.p_value, h.rejected)],
                                          "test string, statistic double, df int, p_value double, rejected boolean"))
