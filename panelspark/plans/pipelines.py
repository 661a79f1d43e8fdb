"""End-to-end plans built from the operators (the reference's user flows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.clean import drop_missing, filter_missingness
from panelspark.operators.impute import impute_progressive
from panelspark.operators.splits import temporal_split
from panelspark.session import cut_lineage
from panelspark.plans.panels import (
    EVENT_FEATURES, EVENT_TARGET, EVENT_TRAIN_END, panel_events,
)


def prepared_events(spark: SparkSession, sf_dir: str, with_method: bool = False,
                    allow_future: bool = True, max_missing: float = 0.30,
                    count_time_as_feature: bool = True, merge: str = "conditional",
                    materialize: bool = True) -> DataFrame:
    """Data preparation flow: merge -> drop missing target -> missingness
    filter -> temporal split -> train medians -> progressive imputation.

    The split panel feeds three consumers (medians, windows, fallbacks); it is
    written once to the shared checkpoint folder (``materialize``) instead of
    re-aggregating the raw events for each of them.
    """
    p = panel_events(spark, sf_dir, method=merge)
    p = drop_missing(p, [EVENT_TARGET])
    p = filter_missingness(p, "user_id", EVENT_FEATURES, max_missing, count_time_as_feature)
    p = temporal_split(p, "bin", EVENT_TRAIN_END)
    if materialize:
        p = cut_lineage(p)
    return impute_progressive(p, "user_id", "bin", EVENT_FEATURES, split_col="split",
                              with_method=with_method, allow_future=allow_future)


# ---------------------------------------------------------------- J13
NATION_Y = "avg_price"
NATION_X = ["n_orders"]
NATION_LAG = "avg_price_lag1"


def nation_lagged_split(spark: SparkSession, sf_dir: str, test_periods: int = 8) -> DataFrame:
    """Lag on the whole panel (S14), then split into the last ``test_periods``
    quarters (test) and the rest (train); checkpointed because the fit and
    the evaluations read it several times."""
    from panelspark.operators.econ import add_lag
    from panelspark.operators.splits import panel_split
    from panelspark.plans.panels import panel_nation
    from panelspark.session import cut_lineage

    p = panel_nation(spark, sf_dir).select(
        F.col("c_nationkey").alias("entity"), F.col("quarter").alias("time"), NATION_Y, *NATION_X)
    p = add_lag(p, "entity", "time", NATION_Y, 1, out=NATION_LAG)
    return cut_lineage(panel_split(p, "time", test_periods=test_periods))


def nation_dynamic_panel(spark: SparkSession, sf_dir: str, test_periods: int = 8, train_only: bool = True):
    """End-to-end dynamic panel run: returns (fit, train, test).

    ``train_only=False`` fits on the whole panel and then scores the test
    slice, which is how the reference's default run leaks (S15).
    """
    from panelspark.operators.econ import fit_twoway_fe

    s = nation_lagged_split(spark, sf_dir, test_periods)
    train = s.where(F.col("split") == "train")
    test = s.where(F.col("split") == "test")
    fe = fit_twoway_fe(train if train_only else s, "entity", "time", NATION_Y, NATION_X + [NATION_LAG])
    return fe, train, test
