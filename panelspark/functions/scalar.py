"""Scalar column expressions (B7, B19, B20, trend labels).

The thresholds below are fixed values that must match the reference's
behaviour; they are stated once, here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------
# score bands: low below -1.0, moderate up to and including 0.5, high above
BAND_LOW_BELOW = -1.0
BAND_MODERATE_UPTO = 0.5
# train-minus-test R2 gap: "good" < 0.05, "moderate" < 0.10, otherwise "overfit"
OVERFIT_GOOD_BELOW = 0.05
OVERFIT_MODERATE_BELOW = 0.10
# train-minus-CV R2 gap flagged as overfitting above 0.1
CV_GAP_FLAG_ABOVE = 0.1
# mean feature importance: HIGH > 0.20, MEDIUM > 0.10, else LOW
IMPORTANCE_HIGH_ABOVE = 0.20
IMPORTANCE_MEDIUM_ABOVE = 0.10
# Nickell bias share (percent): NEGLIGIBLE < 5, MODERATE < 15, else SEVERE
BIAS_NEGLIGIBLE_BELOW = 5.0
BIAS_MODERATE_BELOW = 15.0
# persistence of the lag coefficient: STRONG > 0.7, MODERATE > 0.4, else WEAK
PERSIST_STRONG_ABOVE = 0.7
PERSIST_MODERATE_ABOVE = 0.4
# significance level used by every test verdict
ALPHA = 0.05
# -------------------------------------------------------------------------------


def scalar_row(df) -> Column:
    """A one-row aggregate as a scalar subquery: a struct of its columns.

    Spark runs the subquery once and inlines the result, so no join (and no
    cross join) is needed to attach global statistics to every row; fields
    are read with ``s["name"]``.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")).scalar()


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def try_double(c) -> Column:
    """Tolerant numeric cast (B7): unparsable text becomes NULL, NaN becomes NULL."""
    return nan_to_null(_c(c).try_cast("double"))


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(~F.isnan(c), c)


def band_score(c) -> Column:
    """Low / moderate / high bands of a score."""
    c = _c(c)
    return (F.when(c < BAND_LOW_BELOW, "low")
            .when(c <= BAND_MODERATE_UPTO, "moderate")
            .when(c.isNotNull(), "high"))


def classify_overfit(gap) -> Column:
    g = _c(gap)
    return (F.when(g < OVERFIT_GOOD_BELOW, "good")
            .when(g < OVERFIT_MODERATE_BELOW, "moderate")
            .when(g.isNotNull(), "overfit"))


def classify_importance(v) -> Column:
    v = _c(v)
    return (F.when(v > IMPORTANCE_HIGH_ABOVE, "HIGH")
            .when(v > IMPORTANCE_MEDIUM_ABOVE, "MEDIUM")
            .when(v.isNotNull(), "LOW"))


def classify_bias(pct) -> Column:
    p = _c(pct)
    return (F.when(p < BIAS_NEGLIGIBLE_BELOW, "NEGLIGIBLE")
            .when(p < BIAS_MODERATE_BELOW, "MODERATE")
            .otherwise("SEVERE"))


def classify_persistence(coef) -> Column:
    """Label only defined for 0 < coef < 1 (NULL otherwise)."""
    a = _c(coef)
    return F.when((a > 0) & (a < 1),
                  F.when(a > PERSIST_STRONG_ABOVE, "STRONG")
                  .when(a > PERSIST_MODERATE_ABOVE, "MODERATE")
                  .otherwise("WEAK"))


def half_life(coef) -> Column:
    a = _c(coef)
    return F.when((a > 0) & (a < 1), -F.log(F.lit(2.0)) / F.log(a))


def trend_label(delta) -> Column:
    d = _c(delta)
    return F.when(d > 0, "up").when(d < 0, "down").when(d == 0, "flat")
