"""Panel assembly and cleaning: schema operators (B*), merges (C1), semi/lookup
joins (C3, C4) and the entity missingness filter (D1).

Column names are always passed in by the caller; nothing assumes countries.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from panelspark.functions.scalar import try_double

# --- fixed values --------------------------------------------------------------
# spellings tried, in this order, when standardising the entity column (B2)
ENTITY_SPELLINGS = ["Country Name", "Country", "Country name", "country_name", "country"]
# metadata columns dropped from indicator files when present
METADATA_COLUMNS = ["Indicator Name", "Indicator Code"]
# column names never taken as a time column even when numeric-looking
RESERVED_NAMES = ["Country Name", "Country Code", "Year"]
# accepted time range for a column header to count as a year
YEAR_MIN, YEAR_MAX = 1900, 2100
# -------------------------------------------------------------------------------


# ---------------------------------------------------------------- B1 .. B7
def drop_null_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """B1: drop columns that hold no value at all (one aggregate pass)."""
    cols = list(cols or df.columns)
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols]).first()
    empty = [c for c in cols if counts[c] == 0]
    return df.drop(*empty)


def standardize_entity(df: DataFrame, entity: str = "entity",
                       spellings: Sequence[str] = ENTITY_SPELLINGS) -> DataFrame:
    """B2: rename the first known spelling (else the first column) to ``entity``."""
    if entity in df.columns:
        return df
    src = next((s for s in spellings if s in df.columns), df.columns[0])
    return df.withColumnRenamed(src, entity)


def drop_metadata(df: DataFrame, cols: Sequence[str] = METADATA_COLUMNS) -> DataFrame:
    """Drop metadata columns; absent names are ignored."""
    return df.drop(*cols)


def _whole_number(header) -> int | None:
    """Whole part of a header that spells a finite number, else None."""
    try:
        value = float(header)
    except (TypeError, ValueError):
        return None
    return int(value) if math.isfinite(value) else None


def detect_time_columns(columns: Sequence[str], reserved: Sequence[str] = RESERVED_NAMES,
                        lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> list[str]:
    """B4 (driver, over column *names*): headers that spell a number whose whole
    part lies in [lo, hi] (``2018``, ``2018.0``); reserved names never count."""
    numbers = {c: _whole_number(c) for c in columns if c not in reserved}
    return [c for c, n in numbers.items() if n is not None and lo <= n <= hi]


def wide_to_long(df: DataFrame, id_cols: Sequence[str], value_name: str,
                 time_cols: Sequence[str] | None = None, time: str = "time") -> DataFrame:
    """Melt one column per period into (ids..., time, value).

    Missing values are kept (NULL), rows whose header is not a number are
    dropped; values pass through the tolerant cast (B7).
    """
    time_cols = list(time_cols) if time_cols is not None else detect_time_columns(df.columns)
    if not time_cols:
        raise ValueError("no time columns found")
    src = df.select(*[F.col(f"`{c}`") for c in id_cols],
                    *[try_double(F.col(f"`{c}`")).alias(str(c)) for c in time_cols])
    long = src.unpivot(list(id_cols), [str(c) for c in time_cols], time, value_name)
    t = F.col(time).try_cast("double").cast("int")
    return long.withColumn(time, t).where(F.col(time).isNotNull())


def cast_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Tolerant cast of many columns (bad text and NaN -> NULL)."""
    return df.select(*[try_double(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


# ---------------------------------------------------------------- B8 .. B14
def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``subset``."""
    return df.na.drop(subset=list(subset))


def remap_values(df: DataFrame, col: str, mapping: DataFrame | Mapping[str, str],
                 src: str = "alias", dst: str = "canonical") -> DataFrame:
    """Alias -> canonical value.

    A literal dict becomes a ``CASE`` expression (size bounded by the code);
    a mapping *table* is left-joined (Catalyst broadcasts it only when its
    estimated size is under the broadcast threshold).
    """
    if isinstance(mapping, Mapping):
        if not mapping:
            return df
        expr = F.col(col)
        case = None
        for k, v in mapping.items():
            case = (F.when(F.col(col) == k, v) if case is None else case.when(F.col(col) == k, v))
        return df.withColumn(col, case.otherwise(expr))
    m = mapping.select(F.col(src).alias("__alias"), F.col(dst).alias("__canon"))
    return (df.join(m, F.col(col) == F.col("__alias"), "left")
              .withColumn(col, F.coalesce("__canon", col)).drop("__alias", "__canon"))


def keep_entities(df: DataFrame, allowed: DataFrame | Sequence[str], entity: str = "entity",
                  allowed_col: str | None = None) -> DataFrame:
    """Whitelist as a left-semi join (a literal list becomes ``isin``)."""
    if not isinstance(allowed, DataFrame):
        return df.where(F.col(entity).isin(list(allowed)))
    a = allowed.select(F.col(allowed_col or entity).alias(entity)).distinct()
    return df.join(a, entity, "left_semi")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns by type, minus ``exclude``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def predictors_by_exclusion(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Every column that is not a key/target."""
    return [c for c in df.columns if c not in set(exclude)]


def existing_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project the wanted columns that exist, in the wanted order."""
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns])


def add_residual(df: DataFrame, y: str = "y_true", yhat: str = "y_pred", out: str = "resid") -> DataFrame:
    """B23."""
    return df.withColumn(out, F.col(y) - F.col(yhat))


def infer_time_column(df: DataFrame, candidates: Sequence[str] = ("time", "Year", "year")) -> str | None:
    """First present time column name."""
    return next((c for c in candidates if c in df.columns), None)


# ---------------------------------------------------------------- C1
def _keys_unique(tables: Sequence[DataFrame], keys: Sequence[str]) -> bool:
    """No key occurs twice within a table (one aggregate over all tables)."""
    u = None
    for i, t in enumerate(tables):
        t = t.select(*keys, F.lit(i).alias("__src"))
        u = t if u is None else u.unionByName(t)
    return u.groupBy(*keys, "__src").count().where("count > 1").isEmpty()


def outer_merge(tables: Sequence[DataFrame], keys: Sequence[str], method: str = "auto",
                code_col: str | None = None) -> DataFrame:
    """N-way full outer equi-merge of indicator tables on ``keys``.

    ``auto``  : one exchange: all tables meet in one ``groupBy(keys)`` that keeps an
                array of rows per table; the arrays are multiplied out.  A key that occurs
                repeatedly yields every combination of its rows, as repeated merges do.
    ``join``  : fold of full outer joins (N-1 shuffles), the same rows.
    ``pivot`` : union of long rows + one ``groupBy(keys)`` of plain maxima; raises
                when a key occurs twice within a table (one more aggregate to tell).
    All give the same rows and types for any number of tables; NULL keys are equal to each other.
    ``code_col`` (optional, e.g. a country code carried by some tables) is
    coalesced across tables in table order, never used as a key (S9).
    """
    if not tables:
        raise ValueError("nothing to merge")
    keys = list(keys)
    if method not in ("auto", "join", "pivot"):
        raise ValueError(f"unknown merge method {method!r}")
    if method == "pivot" and not _keys_unique(tables, keys):
        raise ValueError(f"a key of {keys} occurs twice within a table")
    values = [[c for c in t.columns if c not in keys and c != code_col] for t in tables]
    if method == "join":
        return _merge_by_joins(tables, keys, values, code_col)
    if method == "auto":
        return _merge_by_arrays(tables, keys, values, code_col)
    types = {v: tables[i].schema[v].dataType for i, vs in enumerate(values) for v in vs}
    u = None
    for i, t in enumerate(tables):
        cols = [F.col(v) if v in values[i] else F.lit(None).cast(d).alias(v) for v, d in types.items()]
        code = F.col(code_col) if code_col and code_col in t.columns else F.lit(None).cast("string")
        t = t.select(*keys, *cols, code.alias("__code"), F.lit(i).alias("__src"))
        u = t if u is None else u.unionByName(t)
    # one row per key and table: the only non-null value is the value
    aggs = [F.max(F.col(v)).alias(v) for v in types]
    if code_col:
        aggs.append(F.min_by("__code", F.when(F.col("__code").isNotNull(), F.col("__src"))).alias(code_col))
    return u.groupBy(*keys).agg(*aggs)


def _merge_by_arrays(tables, keys, values, code_col) -> DataFrame:
    """All tables in one exchange: an array of rows per key and table, multiplied out inside the key."""
    n, u = len(tables), None
    codes = [i for i, t in enumerate(tables) if code_col and code_col in t.columns]
    rows = [F.struct(F.lit(True).alias("__row"), *[F.col(v) for v in values[i]],
                     *([F.col(code_col).alias("__code")] if i in codes else [])) for i in range(n)]
    types = [t.select(rows[i].alias("s")).schema["s"].dataType for i, t in enumerate(tables)]
    for i, t in enumerate(tables):
        t = t.select(*keys, *[(rows[j] if j == i else F.lit(None).cast(types[j])).alias(f"__s{j}") for j in range(n)])
        u = t if u is None else u.unionByName(t)
    out = u.groupBy(*keys).agg(*[F.collect_list(f"__s{i}").alias(f"__s{i}") for i in range(n)])
    for i in range(n):
        out = out.withColumn(f"__s{i}", F.explode_outer(f"__s{i}"))
    picked = [F.col(f"__s{i}")[v].alias(v) for i in range(n) for v in values[i]]
    if codes:
        picked.append(F.coalesce(*[F.col(f"__s{i}")["__code"] for i in codes]).alias(code_col))
    return out.select(*keys, *picked)


def _merge_by_joins(tables, keys, values, code_col) -> DataFrame:
    out, codes = None, []
    for i, t in enumerate(tables):
        has_code = bool(code_col) and code_col in t.columns
        t = t.select(*keys, *values[i], *([F.col(code_col).alias(f"__code{i}")] if has_code else []))
        codes += [f"__code{i}"] if has_code else []
        if out is None:
            out = t
            continue
        right = t.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in t.columns if c not in keys],
                         F.lit(True).alias("__right"))
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        j = out.withColumn("__left", F.lit(True)).join(right, same, "full_outer")
        picked = [F.when(F.col("__left"), F.col(k)).otherwise(F.col(f"__r_{k}")).alias(k) for k in keys]
        rest = [c for c in [*out.columns, *t.columns] if c not in keys]
        out = j.select(*picked, *rest)
    if codes:
        out = out.withColumn(code_col, F.coalesce(*codes)).drop(*codes)
    return out


# ---------------------------------------------------------------- D1
def missing_share(df: DataFrame, entity: str, feature_cols: Sequence[str],
                  count_time_as_feature: bool = True) -> DataFrame:
    """Per entity: missing feature cells / (rows x (k [+1]))."""
    k = len(feature_cols) + (1 if count_time_as_feature else 0)
    nulls = sum((F.col(c).isNull().cast("long") for c in feature_cols), F.lit(0).cast("long"))
    return df.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(nulls).alias("n_missing"),
    ).withColumn("missing_share", F.col("n_missing") / (F.col("n_rows") * F.lit(k)))


def filter_missingness(df: DataFrame, entity: str, feature_cols: Sequence[str],
                       max_share: float = 0.30, count_time_as_feature: bool = True) -> DataFrame:
    """Keep entities whose missing share is <= ``max_share`` (inclusive, S7).

    The per-entity aggregate is partial + final (hot entities are combined
    map-side); the keep-list is semi-joined back, so AQE may split a skewed
    entity partition of the panel side.
    """
    if not feature_cols:
        return df
    shares = missing_share(df, entity, feature_cols, count_time_as_feature)
    keep = shares.where(F.col("missing_share") <= F.lit(max_share)).select(entity)
    return df.join(keep, entity, "left_semi")


# ---------------------------------------------------------------- B16-B18
def classify_region(df: DataFrame, regions: DataFrame, entity: str = "entity",
                    region_entity: str = "entity", region_col: str = "region",
                    default: str = "Other") -> DataFrame:
    """Dimension left join, unmatched entities get ``default``."""
    r = regions.select(F.col(region_entity).alias("__re"), F.col(region_col).alias("__rg"))
    return (df.join(r, F.col(entity) == F.col("__re"), "left")
              .withColumn(region_col, F.coalesce("__rg", F.lit(default))).drop("__re", "__rg"))


def unmatched_keys(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Report of keys that find no dimension row."""
    d = dim.select(F.col(dim_key or key).alias(key)).distinct()
    return df.select(key).distinct().join(d, key, "left_anti")


def snapshot(df: DataFrame, time: str, at: int | None = None) -> DataFrame:
    """Rows of the latest period (or of ``at``)."""
    if at is not None:
        return df.where(F.col(time) == F.lit(at))
    return df.where(F.col(time) == df.agg(F.max(time)).scalar())


def entity_timeline(df: DataFrame, entity: str, time: str, value, newest_first: bool = False) -> DataFrame:
    """One entity ordered by time (``newest_first`` for the raw-data view).

    ``value`` may be a literal or a Column (e.g. a scalar subquery)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.where(F.col(entity) == v).orderBy(F.col(time).desc() if newest_first else F.col(time))


def sort_panel(df: DataFrame, entity: str, time: str) -> DataFrame:
    """(entity, time) order at output; before writes use
    ``sortWithinPartitions`` instead (see ``sources.sinks``)."""
    return df.orderBy(entity, time)


def successful_rows(df: DataFrame, error_col: str = "error") -> DataFrame:
    """Keep rows without an error."""
    return df.where(F.col(error_col).isNull())


def failed_rows(df: DataFrame, error_col: str = "error") -> DataFrame:
    return df.where(F.col(error_col).isNotNull())
