"""Temporal splits and validation folds.

Folds are small tables (one row per fold and period) joined to the data, so a
fold never materialises a copy of the panel on the driver.  Random folds use a
hash of the key and a seed, never ``randomSplit`` (partition-dependent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import cut_lineage


def temporal_split(df: DataFrame, time: str, train_end: int, split_col: str = "split") -> DataFrame:
    """H1: ``time <= train_end`` -> train, ``> train_end`` -> test; NULL time in neither (dropped)."""
    s = F.when(F.col(time) <= F.lit(train_end), "train").when(F.col(time) > F.lit(train_end), "test")
    return df.withColumn(split_col, s).where(F.col(split_col).isNotNull())


def split_cutoff(df: DataFrame, time: str, train_end: int | None = None, test_periods: int | None = None,
                 test_ratio: float = 0.2) -> DataFrame:
    """H2: one-row table with the first test period (``cutoff``).

    end period given -> end + 1; last n periods -> max - n + 1;
    else ratio of the calendar span, at least one period.
    """
    mm = df.agg(F.min(time).alias("tmin"), F.max(time).alias("tmax"))
    if train_end is not None:
        cut = F.lit(int(train_end) + 1)
    elif test_periods is not None:
        cut = F.col("tmax") - F.lit(int(test_periods)) + 1
    else:
        span = F.col("tmax") - F.col("tmin") + 1
        n_test = F.greatest(F.lit(1), F.floor(span * F.lit(float(test_ratio))).cast("int"))
        cut = F.col("tmax") - n_test + 1
    return mm.select("tmin", "tmax", cut.cast("int").alias("cutoff"))


def panel_split(df: DataFrame, time: str, train_end: int | None = None, test_periods: int | None = None,
                test_ratio: float = 0.2, split_col: str = "split") -> DataFrame:
    """H2: label rows train (< cutoff) / test (>= cutoff); the cutoff is a
    one-row aggregate read as a scalar subquery."""
    cut = split_cutoff(df, time, train_end, test_periods, test_ratio).select("cutoff").scalar()
    return df.withColumn(split_col, F.when(F.col(time) < cut, "train").otherwise("test"))


def period_index(df: DataFrame, time: str) -> DataFrame:
    """Distinct non-null periods with their 1-based rank (small: one row per period)."""
    periods = df.select(time).where(F.col(time).isNotNull()).distinct()
    return periods.withColumn("period_rank", F.row_number().over(Window.orderBy(time)))


def walk_forward_folds(df: DataFrame, time: str, min_train: int = 8, valid: int = 1) -> DataFrame:
    """Fold table (fold, time, role) for expanding-window walk-forward.

    Fold i (0-based) trains on the first ``min_train + i`` distinct periods and
    validates on the next ``valid``. Raises when there are too few periods.
    Each period row expands to the folds it belongs to (``explode`` of an
    integer range), so the table scales with the number of periods, never
    with the number of rows, and no cross join is needed.
    """
    pidx = period_index(df, time)
    n = pidx.count()
    if n < min_train + valid:
        raise ValueError(f"not enough periods ({n}) for min_train={min_train} and valid={valid}")
    last = n - min_train - valid          # last fold index
    r = F.col("period_rank")
    tr_lo = F.greatest(F.lit(0), r - F.lit(min_train))
    va_lo = F.greatest(F.lit(0), r - F.lit(min_train + valid))
    va_hi = F.least(F.lit(last), r - F.lit(min_train + 1))
    train = pidx.where(tr_lo <= F.lit(last)).select(
        F.explode(F.sequence(tr_lo, F.lit(last))).alias("fold"), time, F.lit("train").alias("role"))
    val = pidx.where(va_lo <= va_hi).select(
        F.explode(F.sequence(va_lo, va_hi)).alias("fold"), time, F.lit("valid").alias("role"))
    return train.unionByName(val).withColumn("fold", F.col("fold").cast("int"))


def default_min_train(n_periods: int, cv: int) -> int:
    """First train length ``max(5, min(8, max(5, n - cv)))``."""
    return max(5, min(8, max(5, n_periods - cv)))


def key_hash(key_cols: Sequence[str], seed: int):
    """48-bit hash of the key values and a seed: leading hex digits of an md5, which
    every engine computes alike."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 12), 16, 10).cast("long")


def hash_folds(df: DataFrame, key_cols: Sequence[str], k: int, seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """H4 fallback: deterministic shuffled k-fold label from a key hash."""
    return df.withColumn(fold_col, F.pmod(key_hash(key_cols, seed), F.lit(k)).cast("int"))


def contiguous_folds(df: DataFrame, order_cols: Sequence[str], k: int = 5, fold_col: str = "fold") -> DataFrame:
    """H5: ``k`` contiguous folds in key order, sizes like unshuffled k-fold
    (first ``n % k`` folds one row larger).

    Global positions come from a distributed sort plus per-partition offsets
    (``spark_partition_id`` counts: one row per partition), not from a
    single-partition window.  The sorted rows are written once: offsets and
    rows must come from one and the same sort, whose range borders and
    partition numbers can differ from run to run.
    """
    ordered = cut_lineage(df.orderBy(*order_cols).withColumn("__pid", F.spark_partition_id())
                            .withColumn("__mid", F.monotonically_increasing_id()))
    counts = ordered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"), F.min("__mid").alias("__m0"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(w), F.lit(0)))
    total = counts.agg(F.sum("__cnt")).scalar()
    pos = F.col("__off") + F.col("__mid") - F.col("__m0")
    # one row per partition (bounded by the partition count) -> broadcast
    x = ordered.join(F.broadcast(offsets.select("__pid", "__off", "__m0")), "__pid") \
               .withColumn("__n", total).withColumn("__pos", pos)
    base = F.floor(F.col("__n") / F.lit(k))
    rem = F.col("__n") % F.lit(k)
    big = (base + 1) * rem
    fold = F.when(F.col("__pos") < big, F.floor(F.col("__pos") / (base + 1))) \
            .otherwise(rem + F.floor((F.col("__pos") - big) / base))
    return x.withColumn(fold_col, fold.cast("int")).drop("__pid", "__mid", "__off", "__m0", "__n", "__pos")


def sample_fraction(df: DataFrame, key_cols: Sequence[str], frac: float, seed: int = 42) -> DataFrame:
    """H6: deterministic hash sample of ``frac`` of the rows (learning curves)."""
    return df.where(F.pmod(key_hash(key_cols, seed + 1), F.lit(1000)) < F.lit(int(round(1000 * frac))))
