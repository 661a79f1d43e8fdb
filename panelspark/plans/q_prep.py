"""Driver queries for panel assembly, cleaning, splitting and imputation
(A2-B8, C1, D1-D4, E1, H1-H2) with their DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import clean, impute, splits
from panelspark.plans.panels import (
    EVENT_FEATURES, EVENT_TARGET, EVENT_TRAIN_END, EVENT_TYPES, panel_events, panel_nation, table, event_bin,
)
from panelspark.plans.pipelines import prepared_events
from panelspark.plans.registry import query, rnd, rounded

FEATS = EVENT_FEATURES

# ----------------------------------------------------------------- SQL pieces
_BIN = "CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 3) AS INTEGER)"
_TYPES = ", ".join(f"'{t}'" for t in EVENT_TYPES)
PANEL_SQL = (
    "p AS (SELECT user_id, " + _BIN + " AS bin, "
    + ", ".join(f"avg(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in EVENT_TYPES)
    + f" FROM events WHERE event_type IN ({_TYPES}) GROUP BY 1, 2)"
)
_NULLS = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in FEATS)
KEEP_SQL = (
    "t AS (SELECT * FROM p WHERE purchase IS NOT NULL), "
    f"sh AS (SELECT user_id, count(*) AS n_rows, CAST(sum({_NULLS}) AS BIGINT) AS n_missing, "
    f"sum({_NULLS}) / (count(*) * 5.0) AS missing_share FROM t GROUP BY user_id), "
    f"s AS (SELECT t.*, CASE WHEN bin <= {EVENT_TRAIN_END} THEN 'train' ELSE 'test' END AS split "
    "FROM t WHERE user_id IN (SELECT user_id FROM sh WHERE missing_share <= 0.30))"
)


def _impute_sql(allow_future: bool = True, with_method: bool = False, final: str | None = None) -> str:
    hi = "{r} FOLLOWING" if allow_future else "CURRENT ROW"
    wins = ", ".join(
        f"w{r} AS (PARTITION BY split, user_id ORDER BY bin RANGE BETWEEN {r} PRECEDING AND {hi.format(r=r)})"
        for r in (1, 2, 4))
    wcols = ", ".join(
        f"CASE WHEN count({c}) OVER w{r} >= 2 THEN median({c}) OVER w{r} END AS {c}_{r}"
        for c in FEATS for r in (1, 2, 4))
    med = ", ".join(f"median({c}) AS m_{c}" for c in FEATS)
    smed = ", ".join(f"median({c}) AS sm_{c}" for c in FEATS)
    outs = []
    for c in FEATS:
        g = f"coalesce(m_{c}, sm_{c})"
        outs.append(f"coalesce({c}, {c}_1, {c}_2, {c}_4, {g}) AS {c}")
        if with_method:
            outs.append(f"CASE WHEN {c} IS NOT NULL THEN 'observed' WHEN {c}_1 IS NOT NULL THEN 'w1' "
                        f"WHEN {c}_2 IS NOT NULL THEN 'w2' WHEN {c}_4 IS NOT NULL THEN 'w4' "
                        f"WHEN {g} IS NOT NULL THEN 'global' END AS {c}_method")
    body = (
        f"WITH {PANEL_SQL}, {KEEP_SQL}, "
        f"m AS (SELECT {med} FROM s WHERE split = 'train'), "
        f"sm AS (SELECT split AS sm_split, {smed} FROM s GROUP BY split), "
        f"w AS (SELECT s.*, {wcols} FROM s WINDOW {wins}), "
        f"imp AS (SELECT user_id, bin, split, purchase, {', '.join(outs)} "
        f"FROM w CROSS JOIN m LEFT JOIN sm ON w.split = sm.sm_split) "
    )
    if final is None:
        rc = ", ".join(f"{rnd(c)} AS {c}" for c in ["purchase"] + FEATS)
        mc = (", " + ", ".join(f"{c}_method" for c in FEATS)) if with_method else ""
        final = f"SELECT user_id, bin, split, {rc}{mc} FROM imp"
    return body + final


def _r(cols):
    return ", ".join(f"{rnd(c)} AS {c}" for c in cols)


# ----------------------------------------------------------------- flagship
@query("prep_pipeline", _impute_sql())
def q_prep_pipeline(spark, sf):
    return rounded(prepared_events(spark, sf))


@query("impute_progressive", _impute_sql(with_method=True))
def q_impute_progressive(spark, sf):
    return rounded(prepared_events(spark, sf, with_method=True))


@query("impute_past_only", _impute_sql(allow_future=False, with_method=True))
def q_impute_past_only(spark, sf):
    return rounded(prepared_events(spark, sf, with_method=True, allow_future=False))


_PROV_FINAL = (
    "SELECT split, \"column\", method, count(*) AS n FROM ("
    + " UNION ALL ".join(f"SELECT split, '{c}' AS \"column\", {c}_method AS method FROM imp" for c in FEATS)
    + ") WHERE method IS DISTINCT FROM 'observed' GROUP BY 1, 2, 3"
)


@query("impute_provenance", _impute_sql(with_method=True, final=_PROV_FINAL))
def q_impute_provenance(spark, sf):
    imp = prepared_events(spark, sf, with_method=True)
    return impute.provenance_counts(imp, FEATS)


_REMAIN_FINAL = (
    "SELECT split, CAST(sum(" + " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in FEATS)
    + ") AS BIGINT) AS remaining_nulls, count(*) AS n_rows FROM imp GROUP BY split"
)


@query("remaining_nulls", _impute_sql(final=_REMAIN_FINAL))
def q_remaining_nulls(spark, sf):
    return impute.remaining_nulls(prepared_events(spark, sf), FEATS)


@query("remaining_nulls_raw",
       f"WITH {PANEL_SQL}, {KEEP_SQL} SELECT split, CAST(sum({_NULLS}) AS BIGINT) AS remaining_nulls, count(*) AS n_rows "
       "FROM s GROUP BY split")
def q_remaining_nulls_raw(spark, sf):
    p = clean.filter_missingness(clean.drop_missing(panel_events(spark, sf), [EVENT_TARGET]), "user_id", FEATS)
    return impute.remaining_nulls(splits.temporal_split(p, "bin", EVENT_TRAIN_END), FEATS)


@query("train_medians",
       f"WITH {PANEL_SQL}, {KEEP_SQL} SELECT "
       + ", ".join(f"{rnd(f'median({c})')} AS {c}" for c in FEATS) + " FROM s WHERE split = 'train'")
def q_train_medians(spark, sf):
    p = clean.filter_missingness(clean.drop_missing(panel_events(spark, sf), [EVENT_TARGET]), "user_id", FEATS)
    s = splits.temporal_split(p, "bin", EVENT_TRAIN_END)
    return rounded(impute.train_medians(s, FEATS))


# ----------------------------------------------------------------- C1 merges
_MERGE_SQL = (
    "WITH " + ", ".join(
        f"t_{t} AS (SELECT user_id, {_BIN} AS bin, avg(value) AS {t} FROM events "
        f"WHERE event_type = '{t}' GROUP BY 1, 2)" for t in EVENT_TYPES)
    + " SELECT coalesce(" + ", ".join(f"t_{t}.user_id" for t in EVENT_TYPES) + ") AS user_id, "
    + "coalesce(" + ", ".join(f"t_{t}.bin" for t in EVENT_TYPES) + ") AS bin, "
    + _r(EVENT_TYPES) + " FROM t_purchase"
    + "".join(
        f" FULL OUTER JOIN t_{t} ON t_{t}.user_id = coalesce("
        + ", ".join(f"t_{u}.user_id" for u in EVENT_TYPES[:i]) + ") AND t_" + t + ".bin = coalesce("
        + ", ".join(f"t_{u}.bin" for u in EVENT_TYPES[:i]) + ")"
        for i, t in enumerate(EVENT_TYPES) if i > 0)
)


@query("panel_outer_merge", _MERGE_SQL)
def q_panel_outer_merge(spark, sf):
    return rounded(panel_events(spark, sf, method="join"))


@query("panel_union_pivot", _MERGE_SQL)
def q_panel_union_pivot(spark, sf):
    return rounded(panel_events(spark, sf, method="auto"))


_SOME = EVENT_TYPES[:3]
_REPEAT_SQL = (
    "WITH " + ", ".join(f"t_{t} AS (SELECT DISTINCT user_id, {_BIN} AS bin, CAST(floor(value) AS BIGINT) % 3 AS {t} FROM events "
                        f"WHERE event_type = '{t}')" for t in _SOME)
    + f" SELECT coalesce({', '.join(f't_{t}.user_id' for t in _SOME)}) AS user_id, coalesce({', '.join(f't_{t}.bin' for t in _SOME)}) AS bin, "
    + ", ".join(_SOME) + f" FROM t_{_SOME[0]}"
    + "".join(f" FULL OUTER JOIN t_{t} ON t_{t}.user_id = coalesce({', '.join(f't_{x}.user_id' for x in _SOME[:i])}) "
              f"AND t_{t}.bin = coalesce({', '.join(f't_{x}.bin' for x in _SOME[:i])})" for i, t in enumerate(_SOME) if i))


@query("merge_repeated_keys", _REPEAT_SQL)
def q_merge_repeated(spark, sf):
    """Keys that occur up to three times in every table give all combinations, in one exchange."""
    ev = table(spark, sf, "events")
    tables = [ev.where(F.col("event_type") == t).select("user_id", event_bin().alias("bin"),
                                                        (F.floor("value") % 3).cast("long").alias(t)).distinct() for t in _SOME]
    return clean.outer_merge(tables, ["user_id", "bin"])


@query("panel_conditional_agg", f"WITH {PANEL_SQL} SELECT user_id, bin, {_r(EVENT_TYPES)} FROM p")
def q_panel_conditional(spark, sf):
    return rounded(panel_events(spark, sf))


# ----------------------------------------------------------------- B8, D1, H1, H2
@query("target_dropna", f"WITH {PANEL_SQL} SELECT user_id, bin, {_r(EVENT_TYPES)} FROM p WHERE purchase IS NOT NULL")
def q_target_dropna(spark, sf):
    return rounded(clean.drop_missing(panel_events(spark, sf), [EVENT_TARGET]))


@query("missingness_filter",
       f"WITH {PANEL_SQL}, {KEEP_SQL} SELECT user_id, n_rows, n_missing, " + rnd("missing_share") + " AS missing_share, "
       "missing_share <= 0.30 AS keep FROM sh")
def q_missingness(spark, sf):
    p = clean.drop_missing(panel_events(spark, sf), [EVENT_TARGET])
    sh = clean.missing_share(p, "user_id", FEATS, count_time_as_feature=True)
    return rounded(sh.withColumn("keep", F.col("missing_share") <= F.lit(0.30)))


@query("missingness_no_time",
       f"WITH {PANEL_SQL}, t AS (SELECT * FROM p WHERE purchase IS NOT NULL) "
       f"SELECT user_id, bin FROM t WHERE user_id IN (SELECT user_id FROM t GROUP BY user_id "
       f"HAVING sum({_NULLS}) / (count(*) * 4.0) <= 0.30)")
def q_missingness_no_time(spark, sf):
    p = clean.drop_missing(panel_events(spark, sf), [EVENT_TARGET])
    return clean.filter_missingness(p, "user_id", FEATS, count_time_as_feature=False).select("user_id", "bin")


@query("temporal_split",
       f"WITH {PANEL_SQL}, {KEEP_SQL} SELECT user_id, bin, split FROM s")
def q_temporal_split(spark, sf):
    p = clean.filter_missingness(clean.drop_missing(panel_events(spark, sf), [EVENT_TARGET]), "user_id", FEATS)
    return splits.temporal_split(p, "bin", EVENT_TRAIN_END).select("user_id", "bin", "split")


_NP_SQL = (
    "np AS (SELECT c_nationkey, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS quarter, "
    "avg(o_totalprice) AS avg_price, CAST(count(*) AS DOUBLE) AS n_orders, avg(c_acctbal) AS avg_acctbal, "
    "sum(sq) / sum(nl) AS avg_qty, sum(sd) / sum(nl) AS avg_disc "
    "FROM orders JOIN customer ON o_custkey = c_custkey "
    "LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS sq, count(*) AS nl, sum(l_discount) AS sd "
    "FROM lineitem GROUP BY l_orderkey) li ON o_orderkey = li.l_orderkey GROUP BY 1, 2)"
)
NATION_COLS = ["avg_price", "n_orders", "avg_acctbal", "avg_qty", "avg_disc"]


@query("panel_nation", f"WITH {_NP_SQL} SELECT c_nationkey, quarter, {_r(NATION_COLS)} FROM np")
def q_panel_nation(spark, sf):
    return rounded(panel_nation(spark, sf))


@query("split_last_n",
       f"WITH {_NP_SQL}, c AS (SELECT max(quarter) - 8 + 1 AS cutoff FROM np) "
       "SELECT c_nationkey, quarter, CASE WHEN quarter < cutoff THEN 'train' ELSE 'test' END AS split FROM np, c")
def q_split_last_n(spark, sf):
    return splits.panel_split(panel_nation(spark, sf), "quarter", test_periods=8).select("c_nationkey", "quarter", "split")


@query("split_ratio",
       f"WITH {_NP_SQL}, c AS (SELECT max(quarter) - greatest(1, CAST(floor((max(quarter) - min(quarter) + 1) * 0.2) AS INTEGER)) + 1 AS cutoff FROM np) "
       "SELECT c_nationkey, quarter, CASE WHEN quarter < cutoff THEN 'train' ELSE 'test' END AS split FROM np, c")
def q_split_ratio(spark, sf):
    return splits.panel_split(panel_nation(spark, sf), "quarter", test_ratio=0.2).select("c_nationkey", "quarter", "split")


@query("split_end_period",
       f"WITH {_NP_SQL} SELECT c_nationkey, quarter, CASE WHEN quarter < 8000 + 1 THEN 'train' ELSE 'test' END AS split FROM np")
def q_split_end(spark, sf):
    return splits.panel_split(panel_nation(spark, sf), "quarter", train_end=8000).select("c_nationkey", "quarter", "split")
