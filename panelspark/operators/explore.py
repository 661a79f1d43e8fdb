"""Exploration and chart-dataset aggregates (D9-D20, D23, E3, E5, K*).

Each chart of the reference becomes the table behind it; drawing is left to
the caller.  Every operator is one or two grouped aggregates with map-side
partial aggregation; nothing collects a column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.quantiles import exact_quantiles
from panelspark.functions.scalar import band_score, scalar_row, trend_label

# --- fixed values --------------------------------------------------------------
STRONG_CORR_ABOVE = 0.7      # |r| threshold for "strong pairs"
WHISKER_IQR = 1.5            # box-plot whisker reach in IQRs
KDE_GRID_POINTS = 100
KDE_MIN_VARIANCE = 1e-10     # density skipped below this variance
# -------------------------------------------------------------------------------


def period_summary(df: DataFrame, time: str, value: str) -> DataFrame:
    """Per period sum, count and mean of ``value``."""
    return df.groupBy(time).agg(F.sum(value).alias("total"), F.count(value).alias("n"),
                                F.avg(value).alias("mean"))


def evolution_summary(yearly: DataFrame, time: str) -> DataFrame:
    """D10/E5 over the D9 table (one row per period, bounded by the calendar)."""
    return yearly.agg(
        F.avg("mean").alias("mean_of_means"), F.min("mean").alias("min_mean"), F.max("mean").alias("max_mean"),
        F.min_by(time, "mean").alias("time_of_min"), F.max_by(time, "mean").alias("time_of_max"),
        F.min_by("mean", time).alias("first_mean"), F.max_by("mean", time).alias("last_mean"),
        (F.max_by("mean", time) - F.min_by("mean", time)).alias("total_change"),
        F.avg("n").alias("mean_count"), F.min(time).alias("first_time"), F.max(time).alias("last_time"))


def group_period_stats(df: DataFrame, group: str, time: str, value: str) -> DataFrame:
    """Per group and period: mean, sample std, count."""
    return df.groupBy(group, time).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                                       F.count(value).alias("n"))


def group_change(stats: DataFrame, group: str, time: str) -> DataFrame:
    """Change of the mean from first to last period, groups with >= 2 periods."""
    return stats.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_periods"),
        F.min_by("mean", time).alias("first_mean"), F.max_by("mean", time).alias("last_mean"),
    ).where(F.col("n_periods") >= 2).withColumn("change", F.col("last_mean") - F.col("first_mean"))


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair, pairwise-complete (one aggregate)."""
    cols = list(cols)
    aggs = [F.corr(F.col(a), F.col(b)).alias(f"{i}_{j}")
            for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    if not aggs:
        raise ValueError("need at least two columns")
    wide = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(i).alias("ia"),
                               F.lit(j).alias("ib"), F.col(f"{i}_{j}").alias("r"))
                      for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j])
    upper = wide.select(F.explode(pairs).alias("x")).select("x.*")
    lower = upper.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("ib").alias("ia"),
                         F.col("ia").alias("ib"), "r")
    diag = df.sparkSession.createDataFrame([(c, c, i, i, 1.0) for i, c in enumerate(cols)],
                                           "a string, b string, ia int, ib int, r double")
    return upper.unionByName(lower).unionByName(diag)


def strong_pairs(corr: DataFrame, threshold: float = STRONG_CORR_ABOVE) -> DataFrame:
    """Upper-triangle pairs with |r| above the threshold."""
    return corr.where((F.col("ia") < F.col("ib")) & (F.abs("r") > F.lit(threshold)))


def describe(df: DataFrame, cols: Sequence[str], quantile_method: str = "exact") -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per column (long form)."""
    cols = list(cols)
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
             .unpivot([], cols, "column", "value").where(F.col("value").isNotNull())
    basic = long.groupBy("column").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                       F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                       F.max("value").alias("max"))
    q = exact_quantiles(df, cols, (0.25, 0.5, 0.75), method=quantile_method)
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                   for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return basic.join(qw, "column", "left")


def histogram(df: DataFrame, value: str, bins: int = 30, density: bool = False) -> DataFrame:
    """``bins`` equal-width bins over [min, max]; last bin closed.

    The [min, max] row is a one-row aggregate read as a scalar subquery.
    """
    v = F.col(value).cast("double")
    rng = scalar_row(df.agg(F.min(v).alias("__lo"), F.max(v).alias("__hi"), F.count(v).alias("__n")))
    x = df.where(v.isNotNull()).select(v.alias("v"), rng["__lo"].alias("__lo"), rng["__hi"].alias("__hi"),
                                       rng["__n"].alias("__n"))
    width = (F.col("__hi") - F.col("__lo")) / F.lit(bins)
    raw = F.floor((F.col("v") - F.col("__lo")) / width).cast("int")
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1)))
    h = x.withColumn("bin", b).groupBy("bin", "__lo", "__hi", "__n").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("__hi") - F.col("__lo")) / F.lit(bins)
    h = h.withColumn("bin_lo", F.col("__lo") + F.col("bin") * w).withColumn("bin_hi", F.col("__lo") + (F.col("bin") + 1) * w)
    if density:
        h = h.withColumn("density", F.when(w > 0, F.col("count") / (F.col("__n") * w)))
    return h.drop("__lo", "__hi", "__n")


def boxplot_stats(df: DataFrame, cols: Sequence[str], quantile_method: str = "exact") -> DataFrame:
    """Quartiles, IQR, whiskers (furthest points within 1.5 IQR), mean, outliers."""
    cols = list(cols)
    q = exact_quantiles(df, cols, (0.25, 0.5, 0.75), method=quantile_method)
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                   for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]) \
          .withColumn("iqr", F.col("q3") - F.col("q1"))
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
             .unpivot([], cols, "column", "value").where(F.col("value").isNotNull())
    j = long.join(F.broadcast(qw), "column")   # one row per column: bounded
    lo_f = F.col("q1") - F.lit(WHISKER_IQR) * F.col("iqr")
    hi_f = F.col("q3") + F.lit(WHISKER_IQR) * F.col("iqr")
    inside = (F.col("value") >= lo_f) & (F.col("value") <= hi_f)
    return j.groupBy("column", "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.avg("value").alias("mean"),
        F.count(F.when(~inside, 1)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))


def kde_grid(df: DataFrame, value: str, points: int = KDE_GRID_POINTS) -> DataFrame:
    """Gaussian kernel density at ``points`` grid points over [min, max].

    Bandwidth: Scott's rule ``n^(-1/5) * sample std``.  One aggregate of ``points``
    kernel sums, combined map-side: no row is multiplied and none leaves the JVM.  Skipped (no
    rows) when the variance is <= 1e-10.
    """
    v = F.col(value).cast("double")
    st = df.agg(F.count(v).alias("n"), F.stddev_samp(v).alias("sd"), F.min(v).alias("lo"), F.max(v).alias("hi"),
                F.var_samp(v).alias("var")).first()
    if not (st["var"] or 0.0) > KDE_MIN_VARIANCE:
        return df.sparkSession.createDataFrame([], "i int, x double, density double")
    h, step = float(st["n"]) ** -0.2 * st["sd"], (st["hi"] - st["lo"]) / (points - 1)
    grid = [st["lo"] + i * step for i in range(points)]
    z = [(F.lit(x) - F.col("v")) / F.lit(h) for x in grid]
    sums = df.where(v.isNotNull()).select(v.alias("v")).agg(F.array(*[F.sum(F.exp(F.lit(-0.5) * a * a)) for a in z]).alias("k"))
    rows = sums.select(F.posexplode("k").alias("i", "k"))
    return rows.select("i", F.element_at(F.array(*[F.lit(x) for x in grid]), F.col("i") + 1).alias("x"),
                       (F.col("k") / F.lit(st["n"] * h * math.sqrt(2 * math.pi))).alias("density"))


def kpis(df: DataFrame, entity: str, time: str) -> DataFrame:
    """Distinct entities, time range, row count."""
    return df.agg(F.countDistinct(entity).alias("n_entities"), F.min(time).alias("first_time"),
                  F.max(time).alias("last_time"), F.count(F.lit(1)).alias("n_rows"))


def panel_dims(df: DataFrame, entity: str, time: str, cols: Sequence[str]) -> DataFrame:
    """N and T on complete cases of ``cols``."""
    cc = df.na.drop(subset=list(cols))
    return cc.agg(F.countDistinct(entity).alias("N"), F.countDistinct(time).alias("T"),
                  F.count(F.lit(1)).alias("nobs"))


def mean_bias(preds: DataFrame, group_cols: Sequence[str] = ("model",), y: str = "y_true",
              yhat: str = "y_pred") -> DataFrame:
    """Mean residual (bias) per model."""
    return preds.groupBy(*group_cols).agg(F.avg(F.col(y) - F.col(yhat)).alias("mean_error"),
                                          F.stddev_samp(F.col(y) - F.col(yhat)).alias("std_error"))


def latest_delta(df: DataFrame, entity: str, time: str, value: str) -> DataFrame:
    """Per entity the latest value, the previous one, delta and trend.

    Two aggregates (latest row, then the latest row before it) joined on the
    entity: partial aggregation keeps a hot entity from landing in one task.
    """
    last = df.groupBy(entity).agg(F.max(time).alias("latest_time"), F.max_by(value, time).alias("latest"))
    prev = df.join(last.select(entity, "latest_time"), entity) \
             .where(F.col(time) < F.col("latest_time")) \
             .groupBy(entity).agg(F.max_by(value, time).alias("previous"))
    x = last.join(prev, entity, "left")
    return x.select(entity, "latest_time", "latest", "previous",
                    (F.col("latest") - F.col("previous")).alias("delta"),
                    trend_label(F.col("latest") - F.col("previous")).alias("trend"))


def snapshot_bands(df: DataFrame, entity: str, time: str, score: str) -> DataFrame:
    """Rows of the latest period with the band of their score."""
    snap = df.where(F.col(time) == df.agg(F.max(time)).scalar())
    return snap.select(entity, time, score, band_score(score).alias("band"))


def distinct_entities(df: DataFrame, entity: str) -> DataFrame:
    """distinct entity list (sorted at output)."""
    return df.select(entity).distinct().orderBy(entity)
