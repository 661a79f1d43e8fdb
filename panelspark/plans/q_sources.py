"""Driver queries for sources, sinks, schema operators, scaling and folds
(A5, A6, A8, A11, B1, B4, B5, B7, B9, B10, B16, C3, C4, I1, H3-H6, D22)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.operators import clean, features, metrics, splits
from panelspark.plans.panels import nation_regions, panel_nation, table, event_bin
from panelspark.plans.pipelines import prepared_events
from panelspark.plans.q_prep import FEATS, _BIN, _NP_SQL, _impute_sql
from panelspark.plans.registry import query, rnd, rounded
from panelspark.session import checkpoint_dir, cut_lineage
from panelspark.sources import files, sinks

# demonstration alias map for B9 (alias -> canonical), applied after the merge
ALIASES = {"NATION_1": "Nation One", "NATION_2": "Nation Two", "NATION_3": "Nation Three", "NATION_4": "Nation Four"}
# whitelist = the nations of these regions
KEEP_REGIONS = ["AMERICA", "EUROPE", "ASIA"]
# region dimension deliberately leaves this region out, so its nations fall to "Other" (B16, S22)
UNMAPPED_REGION = "MIDDLE EAST"
FOLDS = 5

WIDE_SQL = (f"{_NP_SQL}, yl AS (SELECT n_name, quarter // 4 AS year, avg(avg_price) AS v FROM np "
            "JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), "
            "grid AS (SELECT n_name, year FROM (SELECT DISTINCT n_name FROM yl), (SELECT DISTINCT year FROM yl)), "
            "wl AS (SELECT grid.n_name, CAST(grid.year AS INTEGER) AS time, yl.v FROM grid LEFT JOIN yl "
            "ON grid.n_name = yl.n_name AND grid.year = yl.year)")


def panel_wide(spark, sf, as_text: bool = False, bad_year: int | None = None):
    """One row per nation name, one column per year (mean of the quarterly
    target).  The pivot values come from a distinct-years aggregate (one row
    per calendar year).  ``as_text`` turns cells into strings, and the
    ``bad_year`` column into the token 'n/a' (B7 / B1 inputs)."""
    p = panel_nation(spark, sf, materialize=True, columns=["avg_price"]).join(nation_regions(spark, sf), "c_nationkey")
    long = p.groupBy("n_name", F.floor(F.col("quarter") / 4).cast("int").alias("year")) \
            .agg(F.avg("avg_price").alias("v"))
    years = sorted(r[0] for r in long.select("year").distinct().collect())
    wide = long.groupBy("n_name").pivot("year", years).agg(F.first("v"))
    if as_text:
        wide = wide.select("n_name", *[(F.lit("n/a") if y == bad_year else F.col(str(y)).cast("string")).alias(str(y))
                                       for y in years])
    return wide


@query("wide_to_long", f"WITH {WIDE_SQL} SELECT n_name, time, {rnd('v')} AS avg_price FROM wl")
def q_wide_to_long(spark, sf):
    w = panel_wide(spark, sf)
    return rounded(clean.wide_to_long(w, ["n_name"], "avg_price"))


@query("detect_time_cols",
       f"WITH {WIDE_SQL} SELECT DISTINCT CAST(time AS VARCHAR) AS \"column\", true AS is_time FROM wl "
       "UNION ALL SELECT 'n_name', false")
def q_detect(spark, sf):
    w = panel_wide(spark, sf)
    t = set(clean.detect_time_columns(w.columns))
    # the column list is schema metadata (bounded by the calendar), not data
    return spark.createDataFrame([(c, c in t) for c in w.columns], "column string, is_time boolean")


@query("try_cast_numeric",
       f"WITH {WIDE_SQL} SELECT n_name, time, CASE WHEN time = 1998 THEN NULL ELSE {rnd('v')} END AS avg_price FROM wl")
def q_try_cast(spark, sf):
    w = panel_wide(spark, sf, as_text=True, bad_year=1998)
    years = clean.detect_time_columns(w.columns)
    return rounded(clean.wide_to_long(clean.cast_numeric(w, years), ["n_name"], "avg_price", years))


@query("drop_null_columns",
       f"WITH {WIDE_SQL} SELECT n_name, time, {rnd('v')} AS avg_price FROM wl WHERE time <> 1998")
def q_drop_null_cols(spark, sf):
    w = panel_wide(spark, sf, as_text=True, bad_year=1998)
    years = clean.detect_time_columns(w.columns)
    w = clean.drop_null_columns(clean.cast_numeric(w, years), years)
    return rounded(clean.wide_to_long(w, ["n_name"], "avg_price", [c for c in years if c in w.columns]))


_CASE = "CASE " + " ".join(f"WHEN n_name = '{k}' THEN '{v}'" for k, v in ALIASES.items()) + " ELSE n_name END"


@query("entity_remap", f"SELECT n_nationkey, {_CASE} AS n_name FROM nation")
def q_remap(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return clean.remap_values(n, "n_name", ALIASES)


@query("entity_remap_table", f"SELECT n_nationkey, {_CASE} AS n_name FROM nation")
def q_remap_table(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    m = spark.createDataFrame(list(ALIASES.items()), "alias string, canonical string")
    return clean.remap_values(n, "n_name", m)


_KEEP = ", ".join(f"'{r}'" for r in KEEP_REGIONS)


@query("whitelist_semi",
       f"WITH {_NP_SQL} SELECT c_nationkey, quarter, {rnd('avg_price')} AS avg_price FROM np WHERE c_nationkey IN "
       f"(SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ({_KEEP}))")
def q_whitelist(spark, sf):
    allowed = nation_regions(spark, sf).where(F.col("region").isin(KEEP_REGIONS))
    p = panel_nation(spark, sf).select("c_nationkey", "quarter", "avg_price")
    return rounded(clean.keep_entities(p, allowed, "c_nationkey"))


@query("region_classify",
       "SELECT n_nationkey AS c_nationkey, coalesce(d.region, 'Other') AS region FROM nation LEFT JOIN "
       "(SELECT n_nationkey AS k, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey "
       f"WHERE r_name <> '{UNMAPPED_REGION}') d ON n_nationkey = d.k")
def q_region_classify(spark, sf):
    dim = nation_regions(spark, sf).where(F.col("region") != UNMAPPED_REGION)
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"))
    return clean.classify_region(n, dim, "c_nationkey", "c_nationkey")


@query("unmatched_regions",
       "SELECT n_nationkey AS c_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT n_nationkey FROM nation "
       f"JOIN region ON n_regionkey = r_regionkey WHERE r_name <> '{UNMAPPED_REGION}')")
def q_unmatched(spark, sf):
    dim = nation_regions(spark, sf).where(F.col("region") != UNMAPPED_REGION)
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"))
    return clean.unmatched_keys(n, dim, "c_nationkey")


@query("long_index_source",
       f"SELECT user_id AS entity, {_BIN} AS time, {rnd('value')} AS view FROM events WHERE event_type = 'view'")
def q_long_index(spark, sf):
    ev = table(spark, sf, "events").select("event_type", "user_id", event_bin().alias("bin"), "value")
    return rounded(files.long_index_source(ev, "event_type", "view", "user_id", "bin", "value", "view"))


@query("processed_roundtrip",
       _impute_sql(final="SELECT user_id, bin, split, " + ", ".join(f"{rnd(c)} AS {c}" for c in ["purchase"] + FEATS)
                   + " FROM imp WHERE split = 'train'"))
def q_processed(spark, sf):
    """A6 + A8: write the prepared panel partitioned by split into the shared
    checkpoint folder, read the train partition back (partition pruning)."""
    path = os.path.join(checkpoint_dir(spark), "panelspark-sinks", uuid.uuid4().hex)
    sinks.write_processed(prepared_events(spark, sf), path, sort_cols=["user_id", "bin"])
    return rounded(files.read_processed(spark, path, "train"))


@query("source_inventory")
def q_inventory(spark, sf):
    expected = ["region", "nation", "customer", "orders", "lineitem", "events", "gdp_per_capita"]
    return files.source_inventory(spark, sf, expected)


_ZC = ["avg_price", "n_orders", "avg_acctbal"]


@query("zscore_features",
       f"WITH {_NP_SQL} SELECT c_nationkey, quarter, "
       + ", ".join(f"{rnd(f'CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () ELSE 0.0 END')} AS {c}_z"
                   for c in _ZC) + " FROM np")
def q_zscore(spark, sf):
    p = panel_nation(spark, sf, materialize=True, columns=_ZC)
    return rounded(features.zscore(p, _ZC, suffix="_z").drop(*_ZC))


@query("walk_forward_folds",
       f"WITH {_NP_SQL}, per AS (SELECT quarter, row_number() OVER (ORDER BY quarter) AS r FROM (SELECT DISTINCT quarter FROM np)), "
       "nf AS (SELECT count(*) - 8 - 1 + 1 AS n FROM per) "
       "SELECT CAST(f.i AS INTEGER) AS fold, quarter, CASE WHEN r <= 8 + f.i THEN 'train' ELSE 'valid' END AS role "
       "FROM per, nf, range(0, 1000) f(i) WHERE f.i < nf.n AND r <= 8 + f.i + 1")
def q_walk_forward(spark, sf):
    p = panel_nation(spark, sf, materialize=True, columns=[])
    n = p.select("quarter").distinct().count()
    return splits.walk_forward_folds(p, "quarter", min_train=splits.default_min_train(n, 5), valid=1)


@query("kfold_contiguous",
       f"WITH {_NP_SQL} SELECT c_nationkey, quarter, "
       f"CAST(ntile({FOLDS}) OVER (ORDER BY c_nationkey, quarter) - 1 AS INTEGER) AS fold FROM np")
def q_kfold(spark, sf):
    p = panel_nation(spark, sf, materialize=True, columns=[])
    return splits.contiguous_folds(p, ["c_nationkey", "quarter"], FOLDS)


_CV_SQL = (
    f"WITH {_NP_SQL}, f AS (SELECT avg_price AS y, n_orders AS x, "
    f"ntile({FOLDS}) OVER (ORDER BY c_nationkey, quarter) - 1 AS fold FROM np), "
    "s AS (SELECT fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy FROM f GROUP BY fold), "
    "t AS (SELECT fold, sum(n) OVER () - n AS n, sum(sx) OVER () - sx AS sx, sum(sy) OVER () - sy AS sy, "
    "sum(sxx) OVER () - sxx AS sxx, sum(sxy) OVER () - sxy AS sxy FROM s), "
    "c AS (SELECT fold, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS b, sy / n - (n * sxy - sx * sy) / (n * sxx - sx * sx) * sx / n AS a FROM t), "
    "sc AS (SELECT f.fold, 1 - sum((y - a - b * x) * (y - a - b * x)) / (var_pop(y) * count(*)) AS r2 FROM f JOIN c USING (fold) GROUP BY f.fold)"
)


@query("cv_scores", f"{_CV_SQL} SELECT CAST(fold AS INTEGER) AS fold, {rnd('r2')} AS r2 FROM sc")
def q_cv_scores(spark, sf):
    return rounded(_cv_fold_scores(spark, sf))


@query("cv_score_summary",
       f"{_CV_SQL} SELECT 'ols_orders' AS model, {rnd('avg(r2)')} AS mean_score, {rnd('stddev_pop(r2)')} AS std_score, "
       "count(*) AS n_folds FROM sc")
def q_cv_summary(spark, sf):
    s = _cv_fold_scores(spark, sf).withColumn("model", F.lit("ols_orders"))
    return rounded(metrics.fold_score_summary(s))


def _cv_fold_scores(spark, sf):
    """H5: contiguous 5-fold CV of a one-feature least-squares line.

    Per-fold sufficient statistics are one aggregate; the training statistics
    of fold f are totals minus fold f (a 5-row table), so no fold copies the
    data."""
    p = panel_nation(spark, sf, materialize=True, columns=["avg_price", "n_orders"]).select("c_nationkey", "quarter", F.col("avg_price").alias("y"),
                                                         F.col("n_orders").alias("x"))
    f = splits.contiguous_folds(p, ["c_nationkey", "quarter"], FOLDS)
    s = f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
                              F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("x") * F.col("y")).alias("sxy"))
    tot = Window.partitionBy()
    t = s.select("fold", *[(F.sum(c).over(tot) - F.col(c)).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")])
    b = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("n") * F.col("sxx") - F.col("sx") ** 2)
    c = t.select("fold", b.alias("b"), (F.col("sy") / F.col("n") - b * F.col("sx") / F.col("n")).alias("a"))
    scored = f.join(F.broadcast(c), "fold").withColumn("y_pred", F.col("a") + F.col("b") * F.col("x"))
    m = metrics.regression_metrics(scored, "y", "y_pred", 1, ["fold"])
    return m.select("fold", "r2")


def _key_hash_sql(seed: int) -> str:
    return (f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', CAST(c_nationkey AS VARCHAR), "
            "CAST(quarter AS VARCHAR))), 1, 12) AS BIGINT)")


@query("hash_folds",
       f"WITH {_NP_SQL} SELECT CAST({_key_hash_sql(42)} % {FOLDS} AS INTEGER) AS fold, count(*) AS count FROM np GROUP BY 1")
def q_hash_folds(spark, sf):
    p = panel_nation(spark, sf, columns=[])
    return splits.hash_folds(p, ["c_nationkey", "quarter"], FOLDS).groupBy("fold").count()


@query("learning_curve_sample",
       f"WITH {_NP_SQL}, h AS (SELECT {_key_hash_sql(43)} % 1000 AS b FROM np), "
       "f AS (SELECT unnest([0.2::DOUBLE, 0.4::DOUBLE, 0.6::DOUBLE, 0.8::DOUBLE, 1.0::DOUBLE]) AS fraction) "
       "SELECT (SELECT count(*) FROM h WHERE b < round(1000 * fraction)) AS n, fraction FROM f")
def q_learning_sample(spark, sf):
    p = panel_nation(spark, sf, columns=[])
    parts = [splits.sample_fraction(p, ["c_nationkey", "quarter"], fr).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("fraction", F.lit(fr)) for fr in (0.2, 0.4, 0.6, 0.8, 1.0)]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("entity_timeline",
       f"WITH {_NP_SQL} SELECT c_nationkey, quarter, {rnd('avg_price')} AS avg_price FROM np "
       "WHERE c_nationkey = (SELECT min(c_nationkey) FROM np)")
def q_entity_timeline(spark, sf):
    """One entity's rows, newest first (the entity is the smallest key,
    found by a scalar subquery)."""
    p = panel_nation(spark, sf, materialize=True, columns=["avg_price"])
    first = p.agg(F.min("c_nationkey")).scalar()
    return rounded(clean.entity_timeline(p, "c_nationkey", "quarter", first, newest_first=True))


@query("full_panel_union",
       _impute_sql(final="SELECT user_id, bin, split, " + ", ".join(f"{rnd(c)} AS {c}" for c in ["purchase"] + FEATS)
                   + " FROM imp"))
def q_full_panel(spark, sf):
    """A6 + A8 + G1: write the prepared panel by split, read train and test
    back separately (partition pruning) and union them into the full panel."""
    path = os.path.join(checkpoint_dir(spark), "panelspark-sinks", uuid.uuid4().hex)
    sinks.write_processed(prepared_events(spark, sf), path, sort_cols=["user_id", "bin"])
    full = files.full_panel(files.read_processed(spark, path, "train"), files.read_processed(spark, path, "test"))
    return rounded(full)


# ---------------------------------------------------------------- A1-A4 + C1 on files
# manifest of the indicator files written and read back by ``indicator_manifest_merge``;
# the first entry is the target, "not_shipped" is listed but never written (A3)
MANIFEST = [files.IndicatorSpec("price", "avg_price"), files.IndicatorSpec("orders", "n_orders"),
            files.IndicatorSpec("not_shipped", "unused"), files.IndicatorSpec("acctbal", "avg_acctbal")]
INDICATOR_METADATA = ['"Data Source","panel indicators",', "", '"Last Updated Date","2024-01-01",', ""]

_MANIFEST_SQL = (
    f"WITH {_NP_SQL}, y AS (SELECT n_name, 'N' || CAST(c_nationkey AS VARCHAR) AS code, r_name, "
    "CAST(floor(quarter / 4) AS INTEGER) AS year, avg(avg_price) AS ap, sum(n_orders) AS no, avg(avg_acctbal) AS ab "
    "FROM np JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3, 4), "
    "y0 AS (SELECT min(year) AS y0 FROM y), "
    "grid AS (SELECT n.n_name, n.code, n.r_name, t.year FROM (SELECT DISTINCT n_name, code, r_name FROM y) n, "
    "(SELECT DISTINCT year FROM y) t) "
    f"SELECT grid.n_name AS entity, grid.code AS \"Country Code\", grid.year AS time, {rnd('y.ap')} AS avg_price, "
    f"CASE WHEN grid.r_name IN ({_KEEP}) THEN {rnd('y.no')} END AS n_orders, "
    f"CASE WHEN grid.year >= y0 + 2 THEN {rnd('y.ab')} END AS avg_acctbal "
    "FROM grid CROSS JOIN y0 LEFT JOIN y ON grid.n_name = y.n_name AND grid.year = y.year"
)


@query("indicator_manifest_merge", _MANIFEST_SQL)
def q_manifest_merge(spark, sf):
    """The reference's loading flow run on files derived from
    the given tables.  Yearly nation indicators are written into the shared
    folder as published-style wide CSVs (metadata lines above the header, one
    column per year) - the price file for every nation, the orders file for the
    nations of three regions - and the account balance as a long Parquet file
    next to a conflicting CSV copy (format precedence must pick Parquet).  The
    manifest also lists a file that does not exist.  Everything is loaded back
    through the manifest and merged with the N-way full outer join."""
    folder = os.path.join(checkpoint_dir(spark), "panelspark-sources", uuid.uuid4().hex)
    p = panel_nation(spark, sf, materialize=True, columns=["avg_price", "n_orders", "avg_acctbal"]).join(
        nation_regions(spark, sf), "c_nationkey")
    yearly = p.groupBy("n_name", F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("code"), "region",
                       F.floor(F.col("quarter") / 4).cast("int").alias("year")).agg(
        F.avg("avg_price").alias("avg_price"), F.sum("n_orders").alias("n_orders"),
        F.avg("avg_acctbal").alias("avg_acctbal"))
    yearly = cut_lineage(yearly)
    years = sorted(r[0] for r in yearly.select("year").distinct().collect())   # bounded by the calendar

    def wide(src, value):
        w = src.groupBy(F.col("n_name").alias("Country Name"), F.col("code").alias("Country Code")) \
               .pivot("year", years).agg(F.first(value))
        return w.select("Country Name", "Country Code",
                        F.lit(value).alias("Indicator Name"), F.lit(value.upper()).alias("Indicator Code"),
                        *[F.col(str(y)) for y in years])

    sinks.write_indicator_csv(wide(yearly, "avg_price"), os.path.join(folder, "price.csv"), INDICATOR_METADATA)
    sinks.write_indicator_csv(wide(yearly.where(F.col("region").isin(KEEP_REGIONS)), "n_orders"),
                              os.path.join(folder, "orders.csv"), INDICATOR_METADATA)
    bal = yearly.where(F.col("year") >= years[0] + 2).select(
        F.col("n_name").alias("Country Name"), F.col("year").alias("Year"), "avg_acctbal")
    bal.write.mode("overwrite").parquet(os.path.join(folder, "acctbal.parquet"))
    sinks.write_indicator_csv(bal.withColumn("avg_acctbal", -F.col("avg_acctbal")),
                              os.path.join(folder, "acctbal.csv"), INDICATOR_METADATA)
    tables = files.load_manifest(spark, folder, MANIFEST)
    merged = clean.outer_merge(tables, ["entity", "time"], code_col="Country Code")
    return rounded(merged)


@query("panel_source_validated",
       f"WITH {_NP_SQL} SELECT c_nationkey, quarter, "
       + ", ".join(f"{rnd(c)} AS {c}" for c in ["avg_price", "n_orders", "avg_acctbal", "avg_qty", "avg_disc"])
       + " FROM np")
def q_panel_source(spark, sf):
    """A panel file (the nation panel written to
    the shared folder) read and validated (required columns present, not
    empty); the time column is inferred, predictors are the numeric columns
    other than the keys and the target, the wanted columns that exist are
    projected, and the panel is sorted by (entity, time) at output."""
    path = os.path.join(checkpoint_dir(spark), "panelspark-sources", uuid.uuid4().hex)
    panel_nation(spark, sf).write.mode("overwrite").parquet(path)
    df = files.validated_panel(spark.read.parquet(path), ["c_nationkey", "quarter", "avg_price"])
    time = clean.infer_time_column(df, ("time", "Year", "year", "quarter"))
    keys = ["c_nationkey", time, "avg_price"]
    preds = [c for c in clean.predictors_by_exclusion(df, keys) if c in clean.numeric_columns(df, keys)]
    out = clean.existing_columns(df, keys + preds + ["not_in_panel"])
    return rounded(clean.sort_panel(out, "c_nationkey", time))
