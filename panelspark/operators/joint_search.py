"""Walk-forward scores of many parameter sets at once.

* Elastic net: one scan gives the second moments of every period.  Prefix sums over the periods are the
  moments of every fold's training rows, differences those of its validation rows; every
  fold and parameter set is then solved by coordinate descent on a k x k matrix, and its
  validation R2 is a quadratic form.  The driver holds periods x k x k numbers, whatever
  the number of rows or parameter sets.
* Nearest neighbours: one neighbour join per fold and Minkowski order with the greatest
  ``n_neighbors``; running means along the ranks are the predictions for all smaller ones.
* Regularised boosting: all folds and parameter sets grow in lockstep (``operators.boosting``).

All take folds as (train end, first and last validation period) and return R2 per parameter set
and fold, NaN where the validation rows have no spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.session import cut_lineage

WORKERS = 4                 # neighbour joins that run at a time


# ---------------------------------------------------------------- moments by period
def _moments(width: int, shift: np.ndarray):
    """Rows (period, w values) -> (period, cell, value): upper triangle of the sums of products of
    (1, values - shift)."""
    iu = np.triu_indices(width + 1)

    def run(batches):
        acc: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            x = np.column_stack([np.ones(len(t)), *[batch.column(i + 1).to_numpy(zero_copy_only=False).astype(float) - shift[i]
                                                    for i in range(width)]])
            periods, at = np.unique(t, return_inverse=True)
            order = np.argsort(at, kind="stable")
            for p, rows in zip(periods, np.split(order, np.cumsum(np.bincount(at))[:-1])):
                m = x[rows].T @ x[rows]
                acc[p] = acc[p] + m if p in acc else m
        for p, m in acc.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(iu[0]), p)), pa.array(np.arange(len(iu[0]), dtype=np.int32)), pa.array(m[iu])],
                ["period", "cell", "v"])
    return run


def period_moments(df: DataFrame, features: Sequence[str], label: str, time: str) -> tuple[list[float], np.ndarray, np.ndarray]:
    """(periods, moments per period, shift) of the complete rows: moments of (1, features, label), all
    shifted by their overall means so that prefix sums lose no digits."""
    cols = [*features, label]
    x = df.select(F.col(time).cast("double").alias("period"), *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    x = x.na.drop()
    names = [f"v{i}" for i in range(len(cols))]
    shift = np.array([v or 0.0 for v in x.agg(*[F.avg(c) for c in names]).first()], float)
    rows = (x.mapInArrow(_moments(len(cols), shift), "period double, cell int, v double")
            .groupBy("period", "cell").agg(F.sum("v").alias("v")).collect())
    periods = sorted({r["period"] for r in rows})
    at = {p: i for i, p in enumerate(periods)}
    iu = np.triu_indices(len(cols) + 1)
    m = np.zeros((len(periods), len(cols) + 1, len(cols) + 1))
    for r in rows:
        a, b = iu[0][r["cell"]], iu[1][r["cell"]]
        m[at[r["period"]], a, b] = m[at[r["period"]], b, a] = r["v"]
    return periods, m, shift


def window_sums(periods: list[float], prefix: np.ndarray, lo: float, hi: float) -> np.ndarray:
    """Moments of the periods lo..hi from prefix sums (one zero matrix first)."""
    a, b = np.searchsorted(periods, lo, "left"), np.searchsorted(periods, hi, "right")
    return prefix[b] - prefix[a]


def spread(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, covariances and population deviations of all columns from their moments."""
    n = max(m[0, 0], 1.0)
    mean = m[0, 1:] / n
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    return mean, cov, np.sqrt(np.maximum(np.diag(cov), 0.0))


# ---------------------------------------------------------------- elastic net
def coordinate_descent(gram: np.ndarray, corr: np.ndarray, alpha: float, l1_ratio: float, max_iter: int = 10000,
                       tol: float = 1e-10) -> np.ndarray:
    """Minimiser of ``w'Gw / 2 - c'w + alpha (l1 |w|_1 + (1 - l1) / 2 |w|^2)``."""
    w = np.zeros(len(corr))
    diag = np.diag(gram)
    for _ in range(max_iter):
        move = 0.0
        for j in range(len(w)):
            if diag[j] <= 1e-12:
                continue
            rho = corr[j] - gram[j] @ w + diag[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - alpha * l1_ratio, 0.0) / (diag[j] + alpha * (1 - l1_ratio))
            move = max(move, abs(new - w[j]))
            w[j] = new
        if move <= tol * max(1.0, np.abs(w).max(initial=0.0)):
            break
    return w


def elastic_net_scores(train: DataFrame, features: Sequence[str], label: str, time: str, folds: list, params: list[dict],
                       key_cols: Sequence[str] = ()) -> list[list[float]]:
    periods, m, _ = period_moments(train, features, label, time)
    prefix = np.concatenate([np.zeros((1, *m.shape[1:])), np.cumsum(m, axis=0)]) if len(m) else m
    out = [[] for _ in params]
    for end, lo, hi in folds:
        mean, cov, sd = spread(window_sums(periods, prefix, -np.inf, end))
        scale = np.where(sd[:-1] > 0, sd[:-1], np.inf)              # a constant feature counts as 0
        gram, corr = cov[:-1, :-1] / np.outer(scale, scale), cov[:-1, -1] / scale
        v = window_sums(periods, prefix, lo, hi)
        sst = v[-1, -1] - v[0, -1] ** 2 / max(v[0, 0], 1.0)
        for i, p in enumerate(params):
            w = coordinate_descent(gram, corr, float(p["alpha"]), float(p["l1_ratio"]), int(p.get("max_iter", 1000))) / scale
            u = np.concatenate([[w @ mean[:-1] - mean[-1]], -w, [1.0]])
            out[i].append(float(1 - (u @ v @ u) / sst) if sst > 0 else float("nan"))
    return out


# ---------------------------------------------------------------- nearest neighbours
def neighbour_scores(train: DataFrame, features: Sequence[str], label: str, time: str, folds: list, params: list[dict],
                     key_cols: Sequence[str] = ()) -> list[list[float]]:
    from panelspark.operators.knn import knn_join
    features = list(features)
    periods, m, shift = period_moments(train, features, label, time)
    prefix = np.concatenate([np.zeros((1, *m.shape[1:])), np.cumsum(m, axis=0)]) if len(m) else m
    rid = F.xxhash64(*(key_cols or [*features, label]))
    base = train.select(F.col(time).cast("double").alias("__t"), rid.alias("__rid"), *[F.col(c).cast("double").alias(c) for c in features],
                        F.col(label).cast("double").alias("__y")).na.drop()
    base = cut_lineage(base.withColumn("__qid", F.monotonically_increasing_id()))
    wanted: dict[int, list[int]] = {}
    for q in params:
        wanted.setdefault(int(q.get("p", 2)), []).append(int(q["n_neighbors"]))

    def one(job):
        (end, lo, hi), p = job
        mean, _, sd = spread(window_sums(periods, prefix, -np.inf, end))
        scaled = [((F.col(c) - F.lit(float(mean[i] + shift[i]))) / F.lit(float(sd[i])) if sd[i] > 0 else F.lit(0.0)).alias(c)
                  for i, c in enumerate(features)]
        ref = base.where(F.col("__t") <= F.lit(float(end))).select("__rid", *scaled, "__y")
        asked = base.where(F.col("__t").between(F.lit(float(lo)), F.lit(float(hi))))
        ks = sorted(set(wanted[p]))
        near = knn_join(asked.select("__qid", *scaled), ref, "__qid", "__rid", features, k=ks[-1], p=p, carry=["__y"])
        ranked = near.groupBy("__qid").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("__y").alias("v")))).alias("l"))

        # one expression for all orders: as a column each, they would cost the driver thousands of calls a join
        pred = ranked.selectExpr("__qid", f"inline(transform(array({', '.join(map(str, ks))}), k -> struct(k AS k, "
                                 "aggregate(slice(l, 1, k), 0D, (acc, x) -> acc + x.v) / least(k, size(l)) AS pred)))")
        got = asked.select("__qid", "__y").join(pred, "__qid").groupBy("k").agg(
            F.sum((F.col("__y") - F.col("pred")) ** 2).alias("sse"), (F.var_pop("__y") * F.count("__y")).alias("sst")).collect()
        return {r["k"]: 1 - r["sse"] / r["sst"] if r["sst"] else float("nan") for r in got}

    jobs = [(fold, p) for fold in folds for p in sorted(wanted)]
    with ThreadPoolExecutor(max_workers=WORKERS) as pool:
        found = dict(zip([(fold, p) for fold, p in jobs], pool.map(one, jobs)))
    return [[float(found[fold, int(q.get("p", 2))].get(int(q["n_neighbors"]), float("nan"))) for fold in folds] for q in params]


# ---------------------------------------------------------------- boosting
def boosting_scores(train: DataFrame, features: Sequence[str], label: str, time: str, folds: list, params: list[dict],
                    key_cols: Sequence[str] = (), refit: dict | None = None):
    from panelspark.operators import boosting
    rows = train.na.drop(subset=[label])
    return boosting.walk_forward_scores(rows, features, label, time, folds, params, key_cols, refit=refit)


SCORERS = {"elastic_net": elastic_net_scores, "knn": neighbour_scores, "boosted_trees": boosting_scores}
