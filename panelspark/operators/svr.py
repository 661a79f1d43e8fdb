"""Kernel support-vector regression by parallel block minimisation.

The dual asks for weights ``beta`` in [-C, C] that sum to 0 and minimise
``beta' K beta / 2 - y' beta + epsilon |beta|_1``.  Every ``SWEEP`` rounds the rows are dealt anew into blocks of
``BLOCK_ROWS``, in between the rows farthest from optimal form one such block; each block solves its own part of the dual exactly
(pairs of steepest ascent and descent, second-order choice), all others held fixed.  The moves together are a direction;
its product with the kernel matrix is one grid of row blocks against moved rows (the exchange of support vectors), and a
line search with a convex bound of the absolute values gives a step that lowers the objective.
Rounds go on until the optimality conditions hold on all rows: no row that may rise has a
smaller slope than one that may fall, to within ``tol``.

Rows, weights and slopes stay in Spark; the driver sees sums, minima and maxima.
A fitted model is its support vectors (a table) and the intercept.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.session import cut_lineage

BLOCK_ROWS = 1024           # rows of a block's own dual
SEND_BYTES = 32 << 20       # support vectors up to this size go to every task, more are dealt in blocks
GRID_ROWS = 8192            # rows of a block of the grid
MAX_ROUNDS = 500
SWEEP = 4                   # every so many rounds all rows move, in between the farthest from optimal


def kernel_matrix(a: np.ndarray, b: np.ndarray, kernel: dict) -> np.ndarray:
    """linear: x.z; poly: (gamma x.z)^degree; rbf: exp(-gamma |x - z|^2)."""
    if kernel["kernel"] == "rbf":
        sq = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2.0 * (a @ b.T)
        return np.exp(-kernel["gamma"] * np.maximum(sq, 0.0))
    if kernel["kernel"] == "poly":
        return (kernel["gamma"] * (a @ b.T)) ** int(kernel["degree"])
    return a @ b.T


# ---------------------------------------------------------------- one block
def slopes(g: np.ndarray, beta: np.ndarray, c: float, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Slope of the objective when a weight rises (inf where it cannot) and when it
    falls, seen upwards (-inf where it cannot)."""
    up = np.where(beta < c, g + np.where(beta >= 0, eps, -eps), np.inf)
    down = np.where(beta > -c, g + np.where(beta > 0, eps, -eps), -np.inf)
    return up, down


def solve_block(k: np.ndarray, g: np.ndarray, beta: np.ndarray, c: float, eps: float, tol: float, max_iter: int = 200_000) -> np.ndarray:
    """Exact minimiser of a block's dual from ``beta`` with slopes ``g = K beta - y`` (others included):
    one pair of weights moves at a time, their sum unchanged."""
    beta, g = beta.copy(), g.copy()
    diag = np.diag(k)
    for _ in range(max_iter):
        up, down = slopes(g, beta, c, eps)
        i = int(np.argmin(up))
        gap = down - up[i]
        if gap.max(initial=-np.inf) <= tol:
            break
        curve = np.maximum(diag[i] + diag - 2.0 * k[i], 1e-12)
        j = int(np.argmax(np.where(gap > 0, gap * np.abs(gap) / curve, -np.inf)))
        # beta_i rises and beta_j falls until the slope is level, a bound is met or a weight changes sign
        t = gap[j] / curve[j]
        t = min(t, c - beta[i], beta[j] + c)
        if beta[i] < 0:
            t = min(t, -beta[i])
        if beta[j] > 0:
            t = min(t, beta[j])
        beta[i] += t
        beta[j] -= t
        for x in (i, j):
            if abs(beta[x]) < 1e-15 * c:
                beta[x] = 0.0
        g += t * (k[i] - k[j])
    return beta


def _solve(kernel: dict, c: float, eps: float, tol: float, names: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        x, beta = pdf[names].to_numpy(dtype=float), pdf["beta"].to_numpy(dtype=float)
        new = solve_block(kernel_matrix(x, x, kernel), pdf["f"].to_numpy() - pdf["y"].to_numpy(), beta, c, eps, tol)
        return pdf.assign(d=new - beta).drop(columns=["part"])
    return run


# ---------------------------------------------------------------- kernel sums
def kernel_sums(rows: DataFrame, vectors: DataFrame, names: Sequence[str], kernel: dict) -> DataFrame:
    """(id, s): sum of ``w K(x, vector)`` over all vectors for every row; rows: id and the columns ``names``, vectors: the same and ``w``.

    Few vectors are sent to every task once their number is known; more are dealt into
    blocks that meet the blocks of rows in a grid, and the blocks' sums are added."""
    names = list(names)
    vectors = vectors.select("w", *names)
    n = vectors.count()
    if n * 8 * (len(names) + 1) <= SEND_BYTES:
        got = vectors.toPandas()                        # bounded, see SEND_BYTES
        v, w = got[names].to_numpy(dtype=float), got["w"].to_numpy(dtype=float)

        def score(batches):
            for pdf in batches:
                x = pdf[names].to_numpy(dtype=float)
                s = np.zeros(len(x))
                step = max(1, (1 << 22) // max(1, len(w)))
                for a in range(0, len(x), step):
                    s[a:a + step] = kernel_matrix(x[a:a + step], v, kernel) @ w
                yield pd.DataFrame({"id": pdf["id"], "s": s})
        return rows.select("id", *names).mapInPandas(score, "id long, s double")
    n_v, n_r = -(-n // GRID_ROWS), max(1, -(-rows.count() // GRID_ROWS))
    r = (rows.select("id", *names).withColumn("rb", F.pmod(F.xxhash64("id"), F.lit(n_r)).cast("int"))
         .withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(n_v - 1)))))
    u = (vectors.withColumn("vb", F.pmod(F.xxhash64("w", *names), F.lit(n_v)).cast("int"))
         .withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(n_r - 1)))))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, v, w = a[names].to_numpy(dtype=float), b[names].to_numpy(dtype=float), b["w"].to_numpy(dtype=float)
        s = [kernel_matrix(x[i:i + 512], v, kernel) @ w for i in range(0, len(x), 512)]
        return pd.DataFrame({"id": a["id"].to_numpy(), "s": np.concatenate(s) if s else np.zeros(0)})
    part = r.groupBy("rb", "vb").cogroup(u.groupBy("rb", "vb")).applyInPandas(meet, "id long, s double")
    return part.groupBy("id").agg(F.sum("s").alias("s"))


# ---------------------------------------------------------------- the solver
def _slope_columns(c: float, eps: float):
    """Columns of ``slopes``: null where a weight cannot rise or fall."""
    g = F.col("f") - F.col("y")
    up = F.when(F.col("beta") < c, g + F.when(F.col("beta") >= 0, F.lit(eps)).otherwise(F.lit(-eps)))
    down = F.when(F.col("beta") > -c, g + F.when(F.col("beta") > 0, F.lit(eps)).otherwise(F.lit(-eps)))
    return up, down


def optimality(state: DataFrame, c: float, eps: float) -> tuple[float, float]:
    """Smallest rising and greatest falling slope over all rows: optimal when the second does not exceed the first."""
    up, down = _slope_columns(c, eps)
    r = state.agg(F.min(up).alias("u"), F.max(down).alias("d")).first()
    return (0.0, 0.0) if r["u"] is None or r["d"] is None else (float(r["u"]), float(r["d"]))


def fit(rows: DataFrame, names: Sequence[str], kernel: dict, c: float, eps: float, tol: float = 1e-3,
        max_rounds: int = MAX_ROUNDS, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, float, dict]:
    """(support vectors (names, w), intercept, info) of ``rows`` (id, y, names); ids are unique.

    ``info``: rounds, violation at the end and whether it is within ``tol``."""
    names = list(names)
    state = cut_lineage(rows.select("id", "y", *names, F.lit(0.0).alias("beta"), F.lit(0.0).alias("f")))
    parts = max(1, -(-state.count() // block_rows))
    schema = "id long, y double, " + ", ".join(f"`{x}` double" for x in names) + ", beta double, f double, d double"
    rounds = 0
    low, high = optimality(state, c, eps)
    while high - low > tol and rounds < max_rounds:
        # blocks need not be more exact than the rounds so far; a single block is the whole problem
        inner = tol / 2 if parts == 1 else max(tol / 2, (high - low) / 20)
        if rounds % SWEEP == 0:
            some = state.withColumn("part", F.pmod(F.xxhash64("id", F.lit(rounds)), F.lit(parts)).cast("int"))
        else:                               # the rows farthest from optimal meet in one block
            up, down = _slope_columns(c, eps)
            far = F.greatest(down - F.lit(low), F.lit(high) - up)
            some = state.withColumn("far", far).orderBy(F.desc_nulls_last("far"), "id").limit(block_rows).drop("far") \
                .withColumn("part", F.lit(0))
        moved = cut_lineage(some.groupBy("part").applyInPandas(_solve(kernel, c, eps, inner, names), schema).where("d != 0"))
        sums = kernel_sums(state, moved.withColumn("w", F.col("d")), names, kernel)
        state = cut_lineage(state.join(moved.select("id", "d"), "id", "left").na.fill(0.0, ["d"]).join(sums, "id"))
        r = state.agg(F.sum((F.col("f") - F.col("y")) * F.col("d")).alias("slope"), F.sum(F.col("d") * F.col("s")).alias("curve"),
                      F.sum(F.abs(F.col("beta") + F.col("d")) - F.abs("beta")).alias("size")).first()
        descent = -(r["slope"] + eps * r["size"])
        step = 0.0 if descent <= 0 else 1.0 if r["curve"] <= 0 else min(1.0, descent / r["curve"])
        new = F.col("beta") + F.lit(step) * F.col("d")
        new = F.when(F.abs(new) < 1e-14 * c, 0.0).when(c - new < 1e-12 * c, c).when(c + new < 1e-12 * c, -c).otherwise(new)
        state = state.select("id", "y", *names, new.alias("beta"), (F.col("f") + F.lit(step) * F.col("s")).alias("f"))
        rounds += 1
        low, high = optimality(state, c, eps)
        if parts == 1:
            break
    vectors = cut_lineage(state.where("beta != 0").select(*names, F.col("beta").alias("w")))
    return vectors, -(low + high) / 2, {"rounds": rounds, "violation": high - low, "converged": high - low <= tol}
