"""Exact quantiles without funnelling a column through one task.

Spark's built-in ``median``/``percentile`` keep a value->count map per group and
merge it in a single task, so a global median over a 100 TB column would hold
every distinct value in one JVM.  ``exact_quantiles`` instead:

1. one aggregate per (group, column): ``count`` and a ``percentile_approx``
   bracket ``[q(p - m), q(p + m)]`` around each requested probability
   (``m = margin / accuracy``; the sketch's rank error is at most n/accuracy,
   so the exact order statistics sit inside the bracket);
2. one pass that counts values below each bracket and keeps only the values
   inside it (about ``2 m n`` rows, a bounded share of the data);
3. exact ranks of the candidates (only they are shuffled): a per-group window when
   every candidate set holds at most ``window_limit`` rows, otherwise a distributed range
   sort with per-partition offsets (no group lands in one task); linear
   interpolation between the two neighbouring order statistics gives the same
   answer as pandas ``median`` / DuckDB ``quantile_cont``.

``method="builtin"`` uses Spark's exact ``percentile`` (fine for small groups),
``method="approx"`` returns the sketch value directly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import cut_lineage

MAX_BROADCAST_BRACKETS = 200_000      # rows (group, column, probability)


def to_long(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (),
            name_col: str = "column", value_col: str = "value") -> DataFrame:
    """(group..., column, value) with NULL and NaN values removed; values cast to double."""
    casted = df.select(*group_cols, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in value_cols])
    long = casted.unpivot(list(group_cols), list(value_cols), name_col, value_col)
    return long.where(F.col(value_col).isNotNull())


def exact_quantiles(df: DataFrame, value_cols: Sequence[str], probs: Sequence[float] = (0.5,),
                    group_cols: Sequence[str] = (), method: str = "exact",
                    accuracy: int = 100_000, margin: float = 8.0,
                    window_limit: int = 2_000_000, direct_limit: int = 500_000) -> DataFrame:
    """Long result: group..., ``column``, ``prob``, ``value``, ``n``.

    Inputs of at most ``direct_limit`` values are ranked as they are.  Beyond, only the
    candidates inside the brackets are shuffled: they are picked on the map side
    with the brackets broadcast (up to ``MAX_BROADCAST_BRACKETS`` rows, counted
    first), and ranked per group (``window_limit`` candidates at most) or by a
    distributed range sort.

    Groups/columns without any non-null value yield no row (callers left-join).
    """
    g = list(group_cols)
    long = to_long(df, value_cols, g)
    keys = g + ["column"]
    probs = [float(p) for p in probs]
    if method == "builtin":
        agg = long.groupBy(*keys).agg(F.count("value").alias("n"),
                                      F.percentile("value", F.array(*[F.lit(p) for p in probs])).alias("qs"))
        return _explode_probs(agg, keys, probs)
    if method == "approx":
        agg = long.groupBy(*keys).agg(
            F.count("value").alias("n"),
            F.percentile_approx("value", F.array(*[F.lit(p) for p in probs]), accuracy).alias("qs"))
        return _explode_probs(agg, keys, probs)
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")

    m = margin / accuracy
    bounds = []
    for p in probs:
        bounds += [max(0.0, p - m), min(1.0, p + m)]
    # pass 1: size and bracket per (group, column)
    sk = long.groupBy(*keys).agg(
        F.count("value").alias("n"),
        F.percentile_approx("value", F.array(*[F.lit(b) for b in bounds]), accuracy).alias("br"))
    pcol = F.explode(F.array(*[
        F.struct(F.lit(i).alias("pi"), F.lit(p).alias("prob"),
                 F.col("br")[2 * i].alias("lo"), F.col("br")[2 * i + 1].alias("hi"))
        for i, p in enumerate(probs)])).alias("pp")
    brackets = sk.select(*keys, "n", pcol).select(*keys, "n", "pp.*")
    pos = (F.col("n") - 1) * F.col("prob")
    brackets = brackets.withColumn("r_lo", F.floor(pos).cast("long")) \
                       .withColumn("r_hi", F.ceil(pos).cast("long")) \
                       .withColumn("frac", pos - F.floor(pos))
    # one row per (group, column, probability): small, written once
    brackets = cut_lineage(brackets)
    size = brackets.agg(F.sum(F.when(F.col("pi") == 0, F.col("n"))).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    bounds_of = F.broadcast(brackets) if size["rows"] <= MAX_BROADCAST_BRACKETS else brackets
    if (size["n"] or 0) <= min(direct_limit, window_limit):
        w = Window.partitionBy(*keys, "pi").orderBy("value")
        ranked = long.join(bounds_of, keys).withColumn("rank", F.row_number().over(w) - 1) \
                     .where((F.col("rank") == F.col("r_lo")) | (F.col("rank") == F.col("r_hi")))
        return _interpolate(ranked, keys)
    # pass 2: values below each bracket and inside it; a bracket that misses
    # one of the two order statistics (tiny groups: the +-m band is narrower
    # than one rank) falls back to all values of that group, which is small
    joined = long.join(bounds_of, keys)
    inb = (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi"))
    stats = joined.groupBy(*keys, "pi").agg(
        F.count(F.when(F.col("value") < F.col("lo"), 1)).alias("below"),
        F.count(F.when(inb, 1)).alias("inside"))
    ok = (F.col("below") <= F.col("r_lo")) & (F.col("below") + F.col("inside") >= F.col("r_hi") + 1)
    stats = cut_lineage(stats.join(brackets.select(*keys, "pi", "r_lo", "r_hi"), keys + ["pi"])
                        .withColumn("__ok", ok).select(*keys, "pi", "below", "inside", "__ok"))
    widest = stats.agg(F.max(F.when(F.col("__ok"), F.col("inside")))).first()[0] or 0
    cand = joined.join(F.broadcast(stats) if size["rows"] <= MAX_BROADCAST_BRACKETS else stats, keys + ["pi"]).where(~F.col("__ok") | inb)
    base = F.when(F.col("__ok"), F.col("below")).otherwise(F.lit(0))
    if widest <= window_limit:
        # every group's candidate set is bounded by ``window_limit`` rows
        w = Window.partitionBy(*keys, "pi").orderBy("value")
        ranked = cand.withColumn("rank", base + F.row_number().over(w) - 1)
    else:
        # large candidate sets: distributed ranking.  A range sort spreads a
        # big group over many tasks; ranks are per-partition offsets (one row
        # per partition and group) plus the position inside the partition.
        srt = cand.withColumn("__base", base).repartitionByRange(*keys, "pi", "value") \
                  .sortWithinPartitions(*keys, "pi", "value") \
                  .withColumn("__pid", F.spark_partition_id()).withColumn("__mid", F.monotonically_increasing_id())
        srt = cut_lineage(srt)          # freeze partition ids and positions
        cnt = srt.groupBy("__pid", *keys, "pi").agg(F.count(F.lit(1)).alias("__c"), F.min("__mid").alias("__m0"))
        wo = Window.partitionBy(*keys, "pi").orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
        off = cnt.withColumn("__off", F.coalesce(F.sum("__c").over(wo), F.lit(0))).drop("__c")
        ranked = srt.join(off, ["__pid", *keys, "pi"]) \
                    .withColumn("rank", F.col("__base") + F.col("__off") + F.col("__mid") - F.col("__m0"))
    ranked = ranked.where((F.col("rank") == F.col("r_lo")) | (F.col("rank") == F.col("r_hi")))
    return _interpolate(ranked, keys)


def _interpolate(ranked: DataFrame, keys: list[str]) -> DataFrame:
    out = ranked.groupBy(*keys, "pi", "prob", "n", "frac").agg(
        F.max(F.when(F.col("rank") == F.col("r_lo"), F.col("value"))).alias("v_lo"),
        F.max(F.when(F.col("rank") == F.col("r_hi"), F.col("value"))).alias("v_hi"))
    return out.select(*keys, "prob",
                      (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("frac")).alias("value"),
                      "n")


def _explode_probs(agg: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    arr = F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("qs").alias("value"))
    return agg.select(*keys, "n", F.explode(arr).alias("z")) \
              .select(*keys, F.col("z.prob").alias("prob"), F.col("z.value").alias("value"), "n")


def medians_wide(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (),
                 method: str = "exact", suffix: str = "") -> DataFrame:
    """One row per group, one median column per value column (``<col><suffix>``)."""
    q = exact_quantiles(df, value_cols, (0.5,), group_cols, method=method)
    aggs = [F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"{c}{suffix}") for c in value_cols]
    if group_cols:
        return q.groupBy(*group_cols).agg(*aggs)
    return q.agg(*aggs)
