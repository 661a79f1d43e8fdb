"""Time-safe imputation: train medians (D2), progressive windowed medians (E1),
provenance counts (D3) and remaining-null counts (D4).

E1 semantics (matching the reference):
* a missing cell of entity e at time t takes the median of the *observed*
  values of the same entity and split within calendar distance r
  (``RANGE`` frame on the integer time column), trying r = 1, 2, 4;
* a radius is accepted only with at least ``min_obs`` (2) observed values;
* windows read original values only (never earlier fills), so the whole fill
  is one set-based window query;
* train and test are filled separately (``split`` is a partition key), the
  last fallback is the train median of the column; when that does not exist
  the median of the observed values in the row's own split is used.

Spark 4.1 rejects ``median`` with a frame, so each row collects the values of
its widest frame once (``collect_list`` of (time, values...)) and derives the
narrower radii and every column from that one array with higher-order
functions: one Window operator for all radii and columns.

Long series are split into time buckets of ``time_bucket`` periods; rows
within ``max(radii)`` of a bucket edge are copied into the neighbouring bucket
as context (halo).  The window is then partitioned by (split, entity, bucket),
so an entity holding a third of all rows is spread over many tasks, with
about 2R/W extra rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.quantiles import medians_wide
from panelspark.functions.scalar import scalar_row

METHODS = ("observed", "w1", "w2", "w4", "global")


def train_medians(df: DataFrame, feature_cols: Sequence[str], split_col: str | None = "split",
                  train_value: str = "train", method: str = "exact") -> DataFrame:
    """One-row table of exact medians per feature over the train rows."""
    src = df.where(F.col(split_col) == F.lit(train_value)) if split_col else df
    return medians_wide(src, feature_cols, method=method)


def _in_frame(time: str, c: str, lo: int, hi: int):
    def pred(x):
        return (x["t"] >= F.col(time) - lo) & (x["t"] <= F.col(time) + hi) & x[c].isNotNull()
    return pred


def _field(c: str):
    def get(x):
        return x[c]
    return get


def _array_median(arr: Column) -> Column:
    n = F.size(arr)
    lo = F.element_at(arr, (F.floor((n - 1) / 2) + 1).cast("int"))
    hi = F.element_at(arr, (F.floor(n / 2) + 1).cast("int"))
    return (lo + hi) / 2


def impute_progressive(df: DataFrame, entity: str, time: str, feature_cols: Sequence[str],
                       split_col: str = "split", train_value: str = "train",
                       radii: Sequence[int] = (1, 2, 4), min_obs: int = 2,
                       allow_future: bool = True, medians: DataFrame | None = None,
                       with_method: bool = False, time_bucket: int | None = 4096,
                       median_method: str = "exact") -> DataFrame:
    """Fill every feature column; optional ``<col>_method`` provenance columns.

    ``medians``: one-row table with a column per feature (D2); computed from the
    train rows when omitted.  ``allow_future=False`` uses past-only frames.
    """
    feats = list(feature_cols)
    radii = sorted(int(r) for r in radii)
    R = radii[-1]
    labels = [f"w{r}" for r in radii]
    # one grouped pass gives the median of every feature in every split: the
    # train row is the fallback (D2), each split's own row the second fallback
    split_med = medians_wide(df, feats, [split_col], method=median_method, suffix="__sm")
    if medians is None:
        medians = split_med.where(F.col(split_col) == F.lit(train_value)) \
                           .select(*[F.col(f"{c}__sm").alias(c) for c in feats])
    # exactly one row (a global aggregate) -> scalar subquery
    med = scalar_row(medians.agg(*[F.first(c).alias(f"__tm_{c}") for c in feats]))
    split_med = split_med.select(F.col(split_col).alias("__sm_split"),
                                 *[F.col(f"{c}__sm").alias(f"__sm_{c}") for c in feats])

    src = df
    part = [split_col, entity]
    if time_bucket:
        W, half = int(time_bucket), int(time_bucket) // 2
        t = F.col(time)
        home = F.floor((t + half) / W)
        lo_b = F.floor((t - (R if allow_future else 0) + half) / W)
        hi_b = F.floor((t + R + half) / W)
        src = (df.withColumn("__home", home)
                 .withColumn("__pb", F.explode(F.coalesce(F.sequence(lo_b, hi_b), F.array(home)))))
        # keep the hash partitioning on all three keys so a hot entity is split by bucket
        src = src.repartition(F.col(split_col), F.col(entity), F.col("__pb"))
        part = [split_col, entity, "__pb"]

    frame_hi = R if allow_future else 0
    w = Window.partitionBy(*part).orderBy(F.col(time)).rangeBetween(-R, frame_hi)
    rec = F.struct(F.col(time).alias("t"), *[F.col(c).cast("double").alias(c) for c in feats])
    src = src.withColumn("__frame", F.collect_list(rec).over(w))
    if time_bucket:
        src = src.where(F.col("__pb").eqNullSafe(F.col("__home"))).drop("__pb", "__home")

    out = src
    for c in feats:
        meds = []
        for r in radii:
            vals = F.filter(F.col("__frame"), _in_frame(time, c, r, r if allow_future else 0))
            arr = F.array_sort(F.transform(vals, _field(c)))
            meds.append(F.when(F.size(arr) >= min_obs, _array_median(arr)))
        out = out.withColumn(f"__w_{c}", F.when(F.col(c).isNull(), F.array(*meds)))
    # one row per split (bounded by the number of splits) -> broadcast
    out = out.drop("__frame").join(F.broadcast(split_med), F.col(split_col) == F.col("__sm_split"), "left")
    cols = []
    for c in df.columns:
        if c not in feats:
            cols.append(F.col(c))
            continue
        wv = [F.col(f"__w_{c}")[i] for i in range(len(radii))]
        glob = F.coalesce(med[f"__tm_{c}"], F.col(f"__sm_{c}"))
        cols.append(F.coalesce(F.col(c).cast("double"), *wv, glob).alias(c))
        if with_method:
            m = F.when(F.col(c).isNotNull(), "observed")
            for i, lab in enumerate(labels):
                m = m.when(wv[i].isNotNull(), lab)
            m = m.when(glob.isNotNull(), "global")
            cols.append(m.alias(f"{c}_method"))
    return out.select(*cols)


def provenance_counts(imputed: DataFrame, feature_cols: Sequence[str], split_col: str = "split") -> DataFrame:
    """D3: (split, column, method, n) from the ``<col>_method`` columns; NULL
    method means the cell is still missing."""
    long = imputed.select(split_col, *[F.col(f"{c}_method").alias(c) for c in feature_cols]) \
                  .unpivot([split_col], list(feature_cols), "column", "method")
    return long.where(~F.col("method").eqNullSafe("observed")) \
               .groupBy(split_col, "column", "method").agg(F.count(F.lit(1)).alias("n"))


def remaining_nulls(df: DataFrame, feature_cols: Sequence[str], split_col: str = "split") -> DataFrame:
    """Remaining missing feature cells per split."""
    nulls = sum((F.col(c).isNull().cast("long") for c in feature_cols), F.lit(0).cast("long"))
    return df.groupBy(split_col).agg(F.sum(nulls).alias("remaining_nulls"), F.count(F.lit(1)).alias("n_rows"))
