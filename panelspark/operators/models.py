"""Regression models as distributed Spark jobs, parameter search and the
train-all orchestration (I1-I19, H3/H4/H7).

* Random forest (I2) and gradient boosting (I4) are Spark ML estimators;
  regularised boosting (I3) grows on distributed histograms (``operators.boosting``).
* Elastic net (I5) is Spark ML ``LinearRegression`` with the parity transform of
  the survey (population-std scaling, label scaled by its population std,
  penalties re-expressed), so coefficients match the usual
  ``alpha * (l1 * |w|_1 + (1 - l1) / 2 * |w|_2^2)`` objective.
* KNN regression (I7) uses the exact k-nearest-neighbour join (``operators.knn``).
* SVR (I6) solves the kernel dual by parallel block minimisation (``operators.svr``).
* MLP (I8) is data-parallel: each iteration sums per-partition gradients
  (``mapInPandas`` -> grouped sum over parameter indices, partially
  aggregated map-side) and the driver applies the Adam step to a
  parameter-sized vector.

The search samples parameters with a seeded generator on the driver; every
trial fits on the walk-forward folds (each fit a Spark job, folds run
concurrently in a small thread pool) and the median rule prunes weak trials.
"""

from __future__ import annotations

import functools
import json
import math
import time as _time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from panelspark.operators.features import fit_zscore
from panelspark.operators.metrics import regression_metrics
from panelspark.session import cut_lineage

SEED = 42


# ---------------------------------------------------------------- search spaces
@dataclass(frozen=True)
class IntP:
    low: int
    high: int

    def sample(self, rng):
        return int(rng.integers(self.low, self.high + 1))

    def text(self):
        return f"{self.low} - {self.high}"


@dataclass(frozen=True)
class FloatP:
    low: float
    high: float
    log: bool = False

    def sample(self, rng):
        if self.log:
            return float(math.exp(rng.uniform(math.log(self.low), math.log(self.high))))
        return float(rng.uniform(self.low, self.high))

    def text(self):
        return f"{self.low:g} - {self.high:g}" + (" (log)" if self.log else "")


@dataclass(frozen=True)
class CatP:
    choices: tuple

    def sample(self, rng):
        return self.choices[int(rng.integers(len(self.choices)))]

    def text(self):
        return ", ".join(str(c) for c in self.choices)


# fixed values: the reference's search spaces
SPACES: dict[str, dict] = {
    "random_forest": {
        "n_estimators": IntP(50, 500), "max_depth": IntP(5, 30), "min_samples_split": IntP(2, 20),
        "min_samples_leaf": IntP(1, 10), "max_features": CatP(("sqrt", "log2", 0.5, 0.7)),
        "min_impurity_decrease": FloatP(0.0, 0.2)},
    "boosted_trees": {
        "n_estimators": IntP(50, 800), "max_depth": IntP(3, 10), "learning_rate": FloatP(0.005, 0.3, True),
        "subsample": FloatP(0.6, 1.0), "colsample_bytree": FloatP(0.6, 1.0), "gamma": FloatP(0.0, 5.0),
        "min_child_weight": IntP(1, 10), "reg_alpha": FloatP(1e-8, 10.0, True),
        "reg_lambda": FloatP(1e-8, 10.0, True)},
    "knn": {"n_neighbors": IntP(3, 50), "weights": CatP(("uniform",)), "p": IntP(1, 3), "leaf_size": IntP(10, 50)},
    "svr": {"kernel": CatP(("linear", "rbf", "poly")), "C": FloatP(0.1, 100.0, True),
            "epsilon": FloatP(0.001, 1.0, True), "gamma": CatP(("scale", "auto")), "degree": IntP(2, 5)},
    "mlp": {"hidden_layer_sizes": CatP(("50", "100", "100_50", "100_100", "200", "200_100")),
            "activation": CatP(("relu", "tanh")), "alpha": FloatP(1e-5, 1e-1, True),
            "learning_rate_init": FloatP(1e-4, 1e-2, True), "max_iter": IntP(300, 1000)},
    "gradient_boosting": {
        "n_estimators": IntP(50, 500), "learning_rate": FloatP(0.001, 0.3, True), "max_depth": IntP(3, 10),
        "min_samples_split": IntP(2, 20), "min_samples_leaf": IntP(1, 10), "subsample": FloatP(0.6, 1.0),
        "max_features": CatP(("sqrt", "log2", 0.5, 0.7))},
    "elastic_net": {"alpha": FloatP(1e-4, 10.0, True), "l1_ratio": FloatP(0.0, 1.0),
                    "max_iter": CatP((1000, 5000, 10000))},
}
# parameters only meaningful for some kernels
CONDITIONAL = {("svr", "gamma"): ("kernel", ("rbf", "poly")), ("svr", "degree"): ("kernel", ("poly",))}
# documented gaps of the Spark realisation (shown in the search-space table)
GAPS = {
    ("knn", "leaf_size"): "index-structure knob (ignored)",
    ("random_forest", "min_samples_split"): "mapped to minInstancesPerNode = max(leaf, ceil(split/2))",
    ("gradient_boosting", "min_samples_split"): "mapped to minInstancesPerNode = max(leaf, ceil(split/2))",
}


def sample_params(model: str, rng) -> dict:
    out = {}
    for k, p in (SPACES[model] if model in SPACES else REGISTRY[model][1]).items():
        cond = CONDITIONAL.get((model, k))
        if cond and out.get(cond[0]) not in cond[1]:
            continue
        out[k] = p.sample(rng)
    return out


def search_space_table(spark: SparkSession) -> DataFrame:
    """The search spaces that drive I9 (one source of truth, S27)."""
    rows = [(m, k, type(p).__name__.replace("P", "").lower(), p.text(), GAPS.get((m, k)))
            for m, sp in SPACES.items() for k, p in sp.items()]
    return spark.createDataFrame(rows, "model string, parameter string, kind string, range string, spark_note string")


# ---------------------------------------------------------------- fitted models
@dataclass
class Fitted:
    name: str
    params: dict
    features: list[str]
    label: str
    predict_fn: Callable[[DataFrame], DataFrame]
    importances: list[float] | None = None
    coefficients: list[float] | None = None
    intercept: float | None = None
    spark_model: object | None = None
    state: dict = field(default_factory=dict)
    reference: DataFrame | None = None           # rows a neighbour model predicts from

    def predict(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        """Adds ``out``; every input column (keys included) is kept."""
        res = self.predict_fn(df)
        return res.withColumnRenamed("y_pred", out) if out != "y_pred" else res

    def save(self, path: str) -> None:
        """A10: Spark ML pipeline via its writer; own models as one JSON row."""
        spark = SparkSession.getActiveSession()
        if self.spark_model is not None:
            self.spark_model.write().overwrite().save(path + "/spark")
        if self.reference is not None:
            self.reference.write.mode("overwrite").parquet(path + "/reference")
        meta = {"name": self.name, "params": self.params, "features": self.features, "label": self.label,
                "coefficients": self.coefficients, "intercept": self.intercept, "importances": self.importances,
                "state": {k: (v.tolist() if isinstance(v, np.ndarray) else v) for k, v in self.state.items()}}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(path + "/meta")


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    """A10: reload a model written by ``Fitted.save``; raises when absent."""
    meta = json.loads(spark.read.json(path + "/meta").first()["meta"])
    name = meta["name"]
    if name in ("random_forest", "gradient_boosting", "elastic_net"):
        from pyspark.ml import PipelineModel
        pm = PipelineModel.load(path + "/spark")
        scale = meta["state"].get("y_scale", 1.0)
        stats = meta["state"].get("zstats")
        f = Fitted(name, meta["params"], meta["features"], meta["label"], None,
                   importances=meta.get("importances"), coefficients=meta["coefficients"],
                   intercept=meta["intercept"], spark_model=pm,
                   state=meta["state"])
        f.predict_fn = _spark_predict(pm, meta["features"], scale, stats)
        return f
    if name == "boosted_trees":
        return _boosted_model(meta["params"], meta["features"], meta["label"], meta["state"], meta.get("importances"))
    if name == "knn":
        return _knn_model(meta["params"], meta["features"], meta["label"], meta["state"]["zstats"],
                          spark.read.parquet(path + "/reference"))
    if name == "svr":
        return _svr_model(meta["params"], meta["features"], meta["label"], meta["state"], spark.read.parquet(path + "/reference"))
    state = {k: (np.array(v) if isinstance(v, list) else v) for k, v in meta["state"].items()}
    return _rebuild_own(name, meta["params"], meta["features"], meta["label"], state)


def _zscore_exprs(features: Sequence[str], stats: dict | None):
    if not stats:
        return [F.col(c).cast("double").alias(c) for c in features]
    out = []
    for c in features:
        m, s = stats[c]
        e = (F.col(c) - F.lit(m)) / F.lit(s) if s and s > 0 else F.lit(0.0)
        out.append(e.alias(c))
    return out


def _fit_stats(df: DataFrame, features: Sequence[str]) -> dict:
    """Population mean/std per feature (I1) from one aggregate row."""
    r = fit_zscore(df, features).first()
    return {c: (float(r[f"{c}__mean"] or 0.0), float(r[f"{c}__std"] or 0.0)) for c in features}


def _spark_predict(pm, features, y_scale=1.0, stats=None):
    def predict(df: DataFrame) -> DataFrame:
        keep = [c for c in df.columns]
        base = df.select(*keep, *[e.alias(f"__f_{c}") for c, e in zip(features, _zscore_exprs(features, stats))])
        out = pm.transform(base).withColumn("y_pred", F.col("__pred") * F.lit(float(y_scale)))
        return out.select(*keep, "y_pred")
    return predict


def _tree_strategy(v) -> str:
    return str(v) if isinstance(v, float) else {"sqrt": "sqrt", "log2": "log2"}.get(v, "all")


@functools.cache
def _lazy_trees(estimator: type) -> type:
    """A Spark ML tree ensemble whose fitted model wraps its trees for Python only when they are asked for.

    A Python model lists its parameters by reading all its attributes, the cached list of its trees among
    them but no plain property: some hundred calls to the JVM a tree, for every fit."""
    from pyspark.ml import regression
    base = getattr(regression, estimator.__name__.replace("Regressor", "RegressionModel"))
    model = type(base.__name__, (base,), {"trees": property(lambda self: base.trees.__get__(self))})
    return type(estimator.__name__, (estimator,), {"_create_model": lambda self, java_model: model(java_model)})


def _fit_spark(name: str, params: dict, train: DataFrame, features: list[str], label: str) -> Fitted:
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    stats = None
    y_scale = 1.0
    lab = F.col(label).cast("double")
    if name == "elastic_net":
        stats = _fit_stats(train, features)
        y_scale = float(train.agg(F.stddev_pop(label)).first()[0] or 1.0) or 1.0
        lab = lab / F.lit(y_scale)
    data = train.select(*[e.alias(f"__f_{c}") for c, e in zip(features, _zscore_exprs(features, stats))],
                        lab.alias("__label"))
    va = VectorAssembler(inputCols=[f"__f_{c}" for c in features], outputCol="__features", handleInvalid="keep")
    common = dict(featuresCol="__features", labelCol="__label", predictionCol="__pred")
    if name == "random_forest":
        leaf = int(params["min_samples_leaf"])
        est = _lazy_trees(RandomForestRegressor)(
            numTrees=int(params["n_estimators"]), maxDepth=min(int(params["max_depth"]), 30),
            minInstancesPerNode=max(leaf, math.ceil(int(params["min_samples_split"]) / 2)),
            featureSubsetStrategy=_tree_strategy(params["max_features"]),
            minInfoGain=float(params["min_impurity_decrease"]), seed=SEED, **common)
    elif name == "gradient_boosting":
        leaf = int(params["min_samples_leaf"])
        est = _lazy_trees(GBTRegressor)(
            maxIter=int(params["n_estimators"]), stepSize=float(params["learning_rate"]),
            maxDepth=int(params["max_depth"]),
            minInstancesPerNode=max(leaf, math.ceil(int(params["min_samples_split"]) / 2)),
            subsamplingRate=float(params["subsample"]),
            featureSubsetStrategy=_tree_strategy(params["max_features"]), seed=SEED, **common)
    elif name == "elastic_net":
        alpha, l1 = float(params["alpha"]), float(params["l1_ratio"])
        a1 = alpha * l1 / y_scale
        reg = a1 + alpha * (1 - l1)
        est = LinearRegression(regParam=reg, elasticNetParam=(a1 / reg) if reg > 0 else 0.0,
                               standardization=False, maxIter=int(params.get("max_iter", 1000)), tol=1e-10,
                               fitIntercept=True, **common)
    else:
        raise ValueError(name)
    pm = Pipeline(stages=[va, est]).fit(data)
    last = pm.stages[-1]
    imp = coef = icpt = None
    if hasattr(last, "featureImportances"):
        imp = [float(v) for v in last.featureImportances.toArray()]
    if name == "elastic_net":
        coef = [float(v) * y_scale for v in last.coefficients.toArray()]
        icpt = float(last.intercept) * y_scale
    st = {"y_scale": y_scale, "zstats": stats}
    return Fitted(name, params, features, label, _spark_predict(pm, features, y_scale, stats),
                  importances=imp, coefficients=coef, intercept=icpt, spark_model=pm, state=st)


# ---------------------------------------------------------------- data-parallel gradients
def _grad_sum(data: DataFrame, n_params: int, fn: Callable[..., np.ndarray]) -> np.ndarray:
    """Sum of ``fn(X, y[, val])`` over all partitions: each task folds its
    batches into one vector and emits (index, value) rows, combined by a
    grouped sum (map-side partial aggregation), so the driver receives one
    parameter-sized vector per iteration, whatever the row count."""
    def part(it):
        acc = None
        for pdf in it:
            has_val = "__val" in pdf.columns
            X = pdf.drop(columns=["__y", "__val"] if has_val else ["__y"]).to_numpy(dtype=float)
            y = pdf["__y"].to_numpy(dtype=float)
            g = fn(X, y, pdf["__val"].to_numpy(dtype=bool)) if has_val else fn(X, y)
            acc = g if acc is None else acc + g
        if acc is not None:
            yield pd.DataFrame({"i": np.arange(len(acc), dtype=np.int64), "v": acc})
    rows = data.mapInPandas(part, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(n_params)
    for r in rows:
        out[r["i"]] = r["v"]
    return out


class _Adam:
    def __init__(self, n, lr, b1=0.9, b2=0.999, eps=1e-8):
        self.m, self.v, self.t, self.lr, self.b1, self.b2, self.eps = np.zeros(n), np.zeros(n), 0, lr, b1, b2, eps

    def step(self, w, g):
        self.t += 1
        self.m = self.b1 * self.m + (1 - self.b1) * g
        self.v = self.b2 * self.v + (1 - self.b2) * g * g
        mh = self.m / (1 - self.b1 ** self.t)
        vh = self.v / (1 - self.b2 ** self.t)
        return w - self.lr * mh / (np.sqrt(vh) + self.eps)


def _fit_svr(params: dict, train: DataFrame, features: list[str], label: str, key_cols: Sequence[str] = (),
             tol: float = 1e-3) -> Fitted:
    """Kernel support-vector regression (``operators.svr``), exact dual solution to within ``tol``.

    The label is standardised inside: ``C`` and ``epsilon`` are in units of its
    standard deviation, so the fit does not depend on the label's scale.
    ``state["converged"]`` says whether the optimality conditions hold on all rows.
    """
    from panelspark.operators import svr
    stats = _fit_stats(train, features)
    names = [f"x{i}" for i in range(len(features))]
    rows = train.select(*[e.alias(x) for x, e in zip(names, _zscore_exprs(features, stats))], F.col(label).cast("double").alias("y")).na.drop()
    rows = cut_lineage(rows.withColumn("id", F.monotonically_increasing_id()))
    y_mu, y_sd = rows.agg(F.avg("y"), F.stddev_pop("y")).first()
    y_mu, y_sd = float(y_mu), float(y_sd or 0.0) or 1.0
    var_x = np.mean([1.0 if s > 0 else 0.0 for _, s in stats.values()]) or 1.0
    kernel = {"kernel": params.get("kernel", "linear"), "degree": int(params.get("degree", 3)),
              "gamma": 1.0 / (len(features) * var_x) if params.get("gamma", "scale") == "scale" else 1.0 / len(features)}
    vectors, intercept, info = svr.fit(rows.withColumn("y", (F.col("y") - y_mu) / y_sd), names, kernel, float(params["C"]),
                                       float(params["epsilon"]), tol)
    state = {"kernel": kernel, "intercept": intercept, "y_mu": y_mu, "y_sd": y_sd, "zstats": stats, **info}
    return _svr_model(params, features, label, state, vectors)


def _svr_model(params: dict, features: list[str], label: str, state: dict, vectors: DataFrame) -> Fitted:
    from panelspark.operators import svr
    names = [f"x{i}" for i in range(len(features))]

    def predict(df: DataFrame) -> DataFrame:
        q = cut_lineage(df.withColumn("__qid", F.monotonically_increasing_id()))
        x = q.select(F.col("__qid").alias("id"), *[e.alias(n) for n, e in zip(names, _zscore_exprs(features, state["zstats"]))]).na.drop()
        got = svr.kernel_sums(x, vectors, names, state["kernel"]).select(
            F.col("id").alias("__qid"), ((F.col("s") + state["intercept"]) * state["y_sd"] + state["y_mu"]).alias("y_pred"))
        return q.join(got, "__qid", "left").drop("__qid")           # rows with a missing feature: no prediction
    return Fitted("svr", params, features, label, predict, state=state, reference=vectors)


def _mlp_shapes(k: int, hidden: str) -> list[tuple[int, int]]:
    sizes = [k] + [int(h) for h in str(hidden).split("_")] + [1]
    return list(zip(sizes[:-1], sizes[1:]))


def _mlp_unpack(w: np.ndarray, shapes):
    out, i = [], 0
    for a, b in shapes:
        W = w[i:i + a * b].reshape(a, b)
        i += a * b
        c = w[i:i + b]
        i += b
        out.append((W, c))
    return out


def _mlp_forward(X, layers, act):
    h = X
    hs = [h]
    for j, (W, c) in enumerate(layers):
        z = h @ W + c
        h = z if j == len(layers) - 1 else (np.maximum(z, 0) if act == "relu" else np.tanh(z))
        hs.append(h)
    return hs


def _fit_mlp(params: dict, train: DataFrame, features: list[str], label: str,
             key_cols: Sequence[str] = (), n_iter_no_change: int = 10, tol: float = 1e-4) -> Fitted:
    stats = _fit_stats(train, features)
    act = params.get("activation", "relu")
    # early stopping: deterministic 10 % validation rows by key hash; one
    # pass per iteration computes the training gradient and the validation
    # error of the current weights together
    keyed = train.withColumn("__val", F.pmod(F.xxhash64(F.lit(SEED), *(key_cols or features)), F.lit(10)) == 0)
    data = cut_lineage(keyed.select(*_zscore_exprs(features, stats), F.col(label).cast("double").alias("__y"),
                                    "__val").na.drop())
    shapes = _mlp_shapes(len(features), params.get("hidden_layer_sizes", "100"))
    rng = np.random.default_rng(SEED)
    parts = []
    for a, b in shapes:
        bound = math.sqrt((2.0 if act == "logistic" else 6.0) / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    w = np.concatenate(parts)
    st = data.where(~F.col("__val")).agg(F.count(F.lit(1)).alias("n"), F.avg("__y").alias("m"),
                                         F.stddev_pop("__y").alias("s")).first()
    n, y_mu, y_sd = int(st["n"]), float(st["m"]), float(st["s"] or 1.0) or 1.0
    alpha = float(params.get("alpha", 1e-4))
    opt = _Adam(len(w), float(params.get("learning_rate_init", 1e-3)))
    best, best_w, stall = -np.inf, w.copy(), 0
    nparam = len(w)

    def grad_fn(cur):
        def grad(X, y, val):
            layers = _mlp_unpack(cur, shapes)
            hs = _mlp_forward(X, layers, act)
            out = hs[-1][:, 0]
            pred = out * y_sd + y_mu
            vy = y[val]
            tail = np.array([((vy - pred[val]) ** 2).sum(), vy.sum(), (vy * vy).sum(), float(len(vy))])
            tr = ~val
            delta = ((out - (y - y_mu) / y_sd) * tr)[:, None]
            gs = []
            for j in range(len(layers) - 1, -1, -1):
                W, _ = layers[j]
                gs.append((hs[j].T @ delta, delta.sum(axis=0)))
                if j > 0:
                    d = delta @ W.T
                    delta = d * ((hs[j] > 0) if act == "relu" else (1 - hs[j] ** 2))
            flat = []
            for gW, gc in reversed(gs):
                flat += [gW.ravel(), gc]
            return np.concatenate(flat + [tail])
        return grad

    wmask = np.concatenate([np.concatenate([np.ones(a * b), np.zeros(b)]) for a, b in shapes])
    for _ in range(int(params.get("max_iter", 300))):
        cur = w.copy()
        gt = _grad_sum(data, nparam + 4, grad_fn(cur))
        s_ = gt[nparam:]
        sst = s_[2] - s_[1] ** 2 / s_[3] if s_[3] >= 2 else 0.0
        score = 1 - s_[0] / sst if sst > 0 else 0.0          # validation R2 of ``cur``
        if score > best + tol:
            best, best_w, stall = score, cur, 0
        else:
            stall += 1
            if stall >= n_iter_no_change:
                break
        w = opt.step(w, gt[:nparam] / n + alpha * wmask * w / n)
    state = {"w": best_w, "zstats_mean": np.array([stats[c][0] for c in features]),
             "zstats_std": np.array([stats[c][1] for c in features]), "y_mu": y_mu, "y_sd": y_sd}
    return _rebuild_own("mlp", params, features, label, state)


def _rebuild_own(name: str, params: dict, features: list[str], label: str, state: dict) -> Fitted:
    """Scoring closure of the perceptron from its numpy parameters."""
    mu, sd = np.asarray(state["zstats_mean"]), np.asarray(state["zstats_std"])
    w = np.asarray(state["w"])
    k = len(features)
    shapes = _mlp_shapes(k, params.get("hidden_layer_sizes", "100"))
    layers = _mlp_unpack(w, shapes)
    act = params.get("activation", "relu")

    def score(X):
        return _mlp_forward(X, layers, act)[-1][:, 0] * state["y_sd"] + state["y_mu"]

    def predict(df: DataFrame) -> DataFrame:
        schema = StructType(list(df.schema.fields) + [StructField("y_pred", DoubleType())])

        def part(it):
            for pdf in it:
                X = pdf[features].to_numpy(dtype=float)
                Xs = np.where(sd > 0, (X - mu) / np.where(sd > 0, sd, 1.0), 0.0)
                out = pdf.copy()
                out["y_pred"] = score(Xs)
                yield out
        return df.mapInPandas(part, schema)
    return Fitted(name, params, features, label, predict, state=state)


def _fit_knn(params: dict, train: DataFrame, features: list[str], label: str, key_cols: Sequence[str] = ()) -> Fitted:
    stats = _fit_stats(train, features)
    # neighbours at equal distance are ranked by a hash of the row's keys, not by its partition
    ref = cut_lineage(train.select(F.xxhash64(*(key_cols or [*features, label])).alias("__rid"),
                                   *_zscore_exprs(features, stats), F.col(label).cast("double").alias("__y")).na.drop())
    return _knn_model(params, features, label, stats, ref)


def _knn_model(params: dict, features: list[str], label: str, stats: dict, ref: DataFrame) -> Fitted:
    from panelspark.operators.knn import knn_regress
    k, p = int(params["n_neighbors"]), int(params.get("p", 2))

    def predict(df: DataFrame) -> DataFrame:
        q = df.withColumn("__qid", F.monotonically_increasing_id())
        q = cut_lineage(q)
        qs = q.select("__qid", *_zscore_exprs(features, stats)).na.drop()
        pred = knn_regress(qs, ref, "__qid", "__rid", features, "__y", k=k, p=p).select("__qid", "y_pred")
        return q.join(pred, "__qid", "left").drop("__qid")          # rows with a missing feature: no prediction
    return Fitted("knn", params, features, label, predict, state={"zstats": stats}, reference=ref)


def _fit_boosted(params: dict, train: DataFrame, features: list[str], label: str, key_cols: Sequence[str] = ()) -> Fitted:
    from panelspark.operators import boosting
    return _boosted_of(params, features, label, *boosting.fit(train, features, label, params, key_cols))


def _boosted_of(params: dict, features: list[str], label: str, e, borders) -> Fitted:
    from panelspark.operators import boosting
    return _boosted_model(params, list(features), label, boosting.to_state(e, borders), boosting.importances(e, len(features)))


def _boosted_model(params: dict, features: list[str], label: str, state: dict, importances) -> Fitted:
    from panelspark.operators import boosting
    e, borders = boosting.from_state(state, params)
    return Fitted("boosted_trees", params, features, label, lambda df: boosting.predict(df, features, e, borders),
                  importances=importances, state=state)


# families added by the caller: name -> (fit function, search space)
REGISTRY: dict[str, tuple[Callable, dict]] = {}


def register_model(name: str, fit_fn: Callable, space: dict) -> None:
    """Add a model family: ``fit_fn(params, train, features, label, key_cols)``
    returns a ``Fitted``; ``space`` maps parameters to search ranges."""
    if name in SPACES or name in REGISTRY:
        raise ValueError(f"model {name} exists")
    REGISTRY[name] = (fit_fn, dict(space))


def fit(name: str, params: dict, train: DataFrame, features: list[str], label: str,
        key_cols: Sequence[str] = ()) -> Fitted:
    """Fit one model family with explicit parameters."""
    features = list(features)
    if name in ("random_forest", "gradient_boosting", "elastic_net"):
        return _fit_spark(name, params, train, features, label)
    if name == "boosted_trees":
        return _fit_boosted(params, train, features, label, key_cols)
    if name == "knn":
        return _fit_knn(params, train, features, label, key_cols)
    if name == "svr":
        return _fit_svr(params, train, features, label, key_cols)
    if name == "mlp":
        return _fit_mlp(params, train, features, label, key_cols)
    if name in REGISTRY:
        return REGISTRY[name][0](params, train, features, label, key_cols)
    raise ValueError(f"unknown model {name}")


# ---------------------------------------------------------------- search
def r2_score(df: DataFrame, label: str, pred: str = "y_pred") -> float:
    return float(regression_metrics(df, label, pred, 0).select("r2").first()["r2"])


def time_folds(df: DataFrame, time: str, min_train: int, valid: int = 1) -> list[tuple[int, int, int]]:
    """Walk-forward folds as (train_end, valid_start, valid_end) period values.

    The distinct periods (bounded by the calendar) are the only thing the
    driver sees; every fold is a range filter on the cached data."""
    periods = [r[0] for r in df.select(time).where(F.col(time).isNotNull()).distinct().orderBy(time).collect()]
    if len(periods) < min_train + valid:
        raise ValueError(f"not enough periods ({len(periods)}) for min_train={min_train} and valid={valid}")
    return [(periods[i - 1], periods[i], periods[i + valid - 1]) for i in range(min_train, len(periods) - valid + 1)]


def cross_validate(name: str, params: dict, train: DataFrame, features: list[str], label: str, time: str, cv: int = 5,
                   workers: int | None = None, key_cols: Sequence[str] = (), refit: bool = False):
    """Walk-forward R2 of one parameter set, fold by fold (see ``search`` for the folds), ``workers`` folds at a time
    (None: as many as the session has cores, at least 4; a fold's jobs wait for each other and keep one core busy).

    ``refit`` also fits the parameters on all rows, beside the folds, and returns (scores, fitted): boosting
    in the folds' lockstep (if every row has a label: its bins count rows without), the others in the folds' pool."""
    from panelspark.operators.joint_search import SCORERS as joint
    from panelspark.operators.splits import default_min_train
    train = cut_lineage(train)
    windows = time_folds(train, time, default_min_train(train.select(time).distinct().count(), cv))
    if name == "boosted_trees" and refit and train.where(F.col(label).isNull()).isEmpty():
        scores, e, borders = joint[name](train, features, label, time, windows, [params], key_cols, refit=params)
        return scores[0], _boosted_of(params, features, label, e, borders)
    if name in joint:
        scores = joint[name](train, features, label, time, windows, [params], key_cols)[0]
        return (scores, fit(name, params, train, features, label, key_cols)) if refit else scores

    def run_fold(w):
        m = fit(name, params, train.where(F.col(time) <= F.lit(w[0])), features, label, key_cols)
        return r2_score(m.predict(train.where(F.col(time).between(F.lit(w[1]), F.lit(w[2])))), label)
    if workers is None:
        workers = max(4, train.sparkSession.sparkContext.defaultParallelism)
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        whole = pool.submit(fit, name, params, train, features, label, key_cols) if refit else None
        scores = list(pool.map(run_fold, windows))
        return (scores, whole.result()) if refit else scores


@dataclass
class SearchResult:
    model: str
    best_params: dict
    cv_score: float
    trials: list[dict]


def search(name: str, train: DataFrame, features: list[str], label: str, time: str,
           n_trials: int = 100, cv: int = 5, seed: int = SEED, workers: int = 4,
           n_startup: int = 10, key_cols: Sequence[str] = (), splitter: Callable | None = None) -> SearchResult:
    """Seeded random search maximising the mean validation R2.

    Folds: ``splitter(train)`` if given (a list of (train, valid) conditions), else
    expanding walk-forward folds over the periods, else, with too few
    periods, ``cv`` shuffled folds by a hash of the row's keys (H4).

    Pruning (from the ``n_startup + 1``-th trial on): after each fold the
    running mean is compared with the median of earlier trials' running means
    at the same fold; a worse trial stops.  Folds of one trial run in a thread
    pool of ``workers`` concurrent Spark jobs, checked batch by batch.

    Walk-forward folds of elastic net, neighbours and regularised boosting are scored
    for all trials together (``operators.joint_search``): from one scan, one neighbour
    join per fold and order, and one job per tree level.
    """
    from panelspark.operators.joint_search import SCORERS as joint
    train = cut_lineage(train)
    n_periods = train.select(time).distinct().count()
    from panelspark.operators.splits import default_min_train
    first = default_min_train(n_periods, cv)
    windows: list = []
    if splitter is not None:
        folds = list(splitter(train))
    elif n_periods > first:
        windows = time_folds(train, time, first)
        folds = [(F.col(time) <= F.lit(end), F.col(time).between(F.lit(lo), F.lit(hi))) for end, lo, hi in windows]
    else:
        part = F.pmod(F.xxhash64(F.lit(seed), *(key_cols or [*features, label])), F.lit(cv))
        folds = [(part != i, part == i) for i in range(cv)]
    rng = np.random.default_rng(seed)
    history: list[list[float]] = []
    trials = []

    def weaker(t: int, running: list[float]) -> bool:
        """H7: after a fold, the running mean lies below the median of the earlier trials."""
        prev = [h[len(running) - 1] for h in history if len(h) >= len(running)]
        return t >= n_startup and bool(prev) and running[-1] < float(np.median(prev))

    def record(params: dict, scores: list[float], running: list[float], pruned: bool) -> None:
        history.append(running)
        trials.append({"trial": len(trials), "params": params, "fold_scores": scores,
                       "mean_score": float(np.mean(scores)) if scores else None, "pruned": pruned})

    if windows and name in joint:
        # all trials and folds are scored together; the pruning rule then says which would have stopped, and where
        drawn = [sample_params(name, rng) for _ in range(n_trials)]
        for params, all_scores in zip(drawn, joint[name](train, features, label, time, windows, drawn, key_cols)):
            running = np.cumsum(all_scores) / np.arange(1, len(all_scores) + 1)
            stop = next((j for j in range(len(running)) if weaker(len(trials), running[:j + 1].tolist())), None)
            end = len(running) if stop is None else stop + 1
            record(params, list(all_scores[:end]), running[:end].tolist(), stop is not None)
    else:
        def run_fold(params, f):
            tr, va = train.where(f[0]), train.where(f[1])
            m = fit(name, params, tr, features, label, key_cols)
            return r2_score(m.predict(va), label)

        with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
            for t in range(n_trials):
                params = sample_params(name, rng)
                scores: list[float] = []
                running: list[float] = []
                pruned = False
                for b in range(0, len(folds), workers):
                    for s in pool.map(lambda f: run_fold(params, f), folds[b:b + workers]):
                        scores.append(s)
                        running.append(float(np.mean(scores)))
                        pruned = weaker(t, running)
                        if pruned:
                            break
                    if pruned:
                        break
                record(params, scores, running, pruned)
    done = [x for x in trials if not x["pruned"] and x["mean_score"] is not None]
    best = max(done or trials, key=lambda x: x["mean_score"] if x["mean_score"] is not None else -np.inf)
    return SearchResult(name, best["params"], best["mean_score"], trials)


def trials_table(spark: SparkSession, res: SearchResult) -> DataFrame:
    rows = [(res.model, x["trial"], {k: str(v) for k, v in x["params"].items()}, [float(s) for s in x["fold_scores"]],
             x["mean_score"], x["pruned"]) for x in res.trials]
    return spark.createDataFrame(rows, "model string, trial int, params map<string,string>, "
                                       "fold_scores array<double>, mean_score double, pruned boolean")


# ---------------------------------------------------------------- I10-I18
@dataclass
class ModelRun:
    model: str
    fitted: Fitted | None
    search: SearchResult | None
    train_score: float | None
    metrics: dict | None
    seconds: float
    error: str | None = None
    fold_scores: list[float] | None = None       # of fixed parameters

    @property
    def cv_score(self) -> float | None:
        if self.search:
            return self.search.cv_score
        return float(np.mean(self.fold_scores)) if self.fold_scores else None


def train_all(train: DataFrame, test: DataFrame, features: list[str], label: str, time: str,
              models: Sequence[str] = tuple(SPACES), n_trials: int = 100, cv: int = 5,
              fixed_params: dict | None = None, key_cols: Sequence[str] = ()) -> list[ModelRun]:
    """Search -> refit on all train rows (I10) -> test metrics.

    A failing model becomes a row with ``error`` instead of stopping the run; what is made of the
    runs without that column takes them through ``complete``.
    ``fixed_params[model]`` skips the search for that model; its parameters are
    cross-validated on the same folds, so that every model has a CV score and gap.
    """
    runs = []
    train = cut_lineage(train)
    test = cut_lineage(test)
    for name in models:
        t0 = _time.time()
        try:
            if fixed_params and name in fixed_params:
                sr = None
                params = fixed_params[name]
                scores, m = cross_validate(name, params, train, features, label, time, cv, key_cols=key_cols, refit=True)
            else:
                scores = None
                sr = search(name, train, features, label, time, n_trials=n_trials, cv=cv, key_cols=key_cols)
                params = sr.best_params
                m = fit(name, params, train, features, label, key_cols)
            tr_score = r2_score(m.predict(train), label)
            met = regression_metrics(m.predict(test), label, "y_pred", len(features), with_pvalue=True).first().asDict()
            runs.append(ModelRun(name, m, sr, tr_score, met, _time.time() - t0, fold_scores=scores))
        except Exception as exc:  # noqa: BLE001
            runs.append(ModelRun(name, None, None, None, None, _time.time() - t0, f"{type(exc).__name__}: {exc}"))
    return runs


def complete(runs: Sequence[ModelRun]) -> list[ModelRun]:
    """The runs, all of them; raises if a model failed, whose rows would be missing without a word."""
    failed = [f"{r.model} ({r.error})" for r in runs if r.error is not None]
    if failed:
        raise RuntimeError("models failed: " + "; ".join(failed))
    return list(runs)


def results_table(spark: SparkSession, runs: Sequence[ModelRun]) -> DataFrame:
    """One row per model with train, CV and test scores."""
    rows = []
    for r in runs:
        m = r.metrics or {}
        cv = r.cv_score
        gap = (r.train_score - cv) if (r.train_score is not None and cv is not None) else None
        rows.append((r.model, r.train_score, cv, gap, (gap > 0.1) if gap is not None else None,
                     m.get("r2"), m.get("adj_r2"), m.get("f_stat"), m.get("f_pvalue"), m.get("rmse"), m.get("mae"),
                     m.get("n"), m.get("p"),
                     {k: str(v) for k, v in (r.fitted.params.items() if r.fitted else [])}, float(r.seconds), r.error))
    return spark.createDataFrame(rows, "model string, train_score double, cv_score double, gap double, "
                                       "overfit boolean, r2 double, adj_r2 double, f_stat double, f_pvalue double, "
                                       "rmse double, mae double, n long, p int, best_params map<string,string>, "
                                       "seconds double, error string")


def top_features(imp: DataFrame, n: int = 10, model: str = "model", by: str = "importance") -> DataFrame:
    """The ``n`` most important features of every model (top-k per
    group with a window; ties broken by feature name)."""
    from pyspark.sql import Window
    w = Window.partitionBy(model).orderBy(F.col(by).desc(), F.col("feature"))
    return imp.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def feature_importance(spark: SparkSession, runs: Sequence[ModelRun]) -> DataFrame:
    """(model, feature, importance) for the tree models, sorted desc per model."""
    rows = [(r.model, f, float(v)) for r in runs if r.fitted and r.fitted.importances
            for f, v in zip(r.fitted.features, r.fitted.importances)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def importance_table(imp: DataFrame) -> DataFrame:
    """Mean importance per feature across models + label, pivot per model."""
    from panelspark.functions.scalar import classify_importance
    models = sorted(r[0] for r in imp.select("model").distinct().collect())
    wide = imp.groupBy("feature").pivot("model", models).agg(F.first("importance"))
    mean = imp.groupBy("feature").agg(F.avg("importance").alias("mean_importance"))
    return wide.join(mean, "feature").withColumn("level", classify_importance("mean_importance"))


def coefficients_table(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """Linear coefficients by name, ordered by magnitude at output."""
    rows = [(f, float(c), abs(float(c))) for f, c in zip(fitted.features, fitted.coefficients or [])]
    return spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")
