"""Registry of driver queries: name -> (spark builder, DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# fixed value: snap boundary offset, an irrational-looking constant so that no
# short decimal or dyadic fraction (.5, .25, .75, .1, ...) lies on a boundary
SNAP_OFFSET = 0.381966

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def snap_col(c: Column, sig: int = 10, max_dec: int = 6) -> Column:
    """Spark side of the snap: ``sig`` significant digits, at most ``max_dec``
    decimals (power-of-ten scales only, identical IEEE steps in both engines)."""
    x = c.cast("double")
    k = F.floor(F.log10(F.abs(x)))
    d = F.least(F.lit(max_dec).cast("long"), F.lit(sig - 1) - k)
    up = F.pow(F.lit(10.0), d.cast("double"))
    dn = F.pow(F.lit(10.0), (-d).cast("double"))
    return (F.when(x == 0, F.lit(0.0))
             .when(d >= 0, F.floor(x * up + F.lit(SNAP_OFFSET)) / up)
             .otherwise(F.floor(x / dn + F.lit(SNAP_OFFSET)) * dn) + F.lit(0.0))


def rounded(df: DataFrame, sig: int = 10, max_dec: int = 6) -> DataFrame:
    """Snap every floating column so results compare equal across engines
    whose summation order differs (see ``snap_col`` / ``rnd``).

    A plain round is unsafe: averages of 2-decimal prices over power-of-two
    counts end exactly on a half step, where one ulp of engine noise flips the
    result.  The snap is ``floor(x * 10^d + SNAP_OFFSET) / 10^d`` whose
    boundaries sit away from every short decimal or dyadic fraction; ``d``
    keeps ``sig`` significant digits (at most ``max_dec`` decimals).  Adding
    0.0 turns -0.0 into 0.0.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = snap_col(c, sig, max_dec).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def rnd(expr: str, sig: int = 10, max_dec: int = 6) -> str:
    """SQL twin of ``snap_col``."""
    x = f"CAST(({expr}) AS DOUBLE)"
    d = f"least({max_dec}, {sig - 1} - CAST(floor(log10(abs({x}))) AS BIGINT))"
    return (f"(CASE WHEN {x} = 0 THEN 0.0 WHEN {d} >= 0 "
            f"THEN floor({x} * power(10.0, {d}) + {SNAP_OFFSET}) / power(10.0, {d}) "
            f"ELSE floor({x} / power(10.0, -{d}) + {SNAP_OFFSET}) * power(10.0, -{d}) END + 0.0)")


def erfc_sql(x: str, terms: int = 50, depth: int = 40) -> str:
    """DuckDB has no ``erf``: complementary error function of the column
    ``x`` (>= 0) as SQL.  A ``terms``-term Taylor series of erf in Horner form
    for x <= 3, a continued fraction of depth ``depth`` beyond; absolute error
    below 1e-12 (p-values are compared at 1e-6).  ``x`` should be a plain
    column name: it is repeated inside the expression."""
    import math
    lit = lambda v: f"CAST({float(v)!r} AS DOUBLE)"          # noqa: E731
    coef = [(-1) ** n / (math.factorial(n) * (2 * n + 1)) for n in range(terms)]
    horner = lit(coef[-1])
    for c in reversed(coef[:-1]):
        horner = f"({lit(c)} + ({x} * {x}) * {horner})"
    cf = x
    for n in range(depth, 0, -1):
        cf = f"({x} + {lit(n / 2)} / {cf})"
    return (f"(CASE WHEN {x} <= 3 THEN 1 - 2 / sqrt(pi()) * {x} * {horner} "
            f"ELSE exp(-{x} * {x}) / sqrt(pi()) / {cf} END)")
