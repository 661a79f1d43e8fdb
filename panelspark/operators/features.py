"""Feature assembly and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.scalar import scalar_row


def zscore(df: DataFrame, cols: Sequence[str], suffix: str = "", population: bool = True,
           stats: DataFrame | None = None) -> DataFrame:
    """(x - mean) / std with the *population* std (scikit's convention;
    Spark's StandardScaler divides by the sample std).  ``stats`` (one row of
    ``<c>__mean`` / ``<c>__std``) lets test data reuse the train statistics.
    The statistics row is one aggregate, read as a scalar subquery."""
    cols = list(cols)
    if stats is None:
        sd = F.stddev_pop if population else F.stddev_samp
        stats = fit_zscore(df, cols, sd)
    s = scalar_row(stats)

    def z(c):
        return F.when(s[f"{c}__std"] > 0, (F.col(c) - s[f"{c}__mean"]) / s[f"{c}__std"]).otherwise(F.lit(0.0))
    if suffix:
        return df.select(*df.columns, *[z(c).alias(f"{c}{suffix}") for c in cols])
    return df.select(*[z(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def fit_zscore(df: DataFrame, cols: Sequence[str], sd=F.stddev_pop) -> DataFrame:
    return df.agg(*[F.avg(c).alias(f"{c}__mean") for c in cols], *[sd(c).alias(f"{c}__std") for c in cols])


def assemble(df: DataFrame, feature_cols: Sequence[str], label: str | None = None,
             out: str = "features") -> DataFrame:
    """Features vector + label column (keys are carried along, C5)."""
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=list(feature_cols), outputCol=out, handleInvalid="keep")
    res = va.transform(df)
    return res.withColumnRenamed(label, "label") if label and label != "label" else res
