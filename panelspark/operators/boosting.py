"""Regularised gradient boosting on distributed histograms.

Second-order boosting for squared error: a leaf weighs ``-T(G) / (H + reg_lambda)`` with
``G`` and ``H`` the sums of gradient and curvature of its rows and ``T`` the soft
threshold by ``reg_alpha``.  A split is worth the gain of its two leaves over the unsplit one; both
sides need a curvature of ``min_child_weight``, and once a tree is grown, splits whose
gain is below ``gamma`` are taken back from the bottom up.  ``subsample`` and
``colsample_bytree`` draw rows and columns per tree.

Rows are binned once (borders: distributed quantiles; every distinct value is a border of its own where a
feature has fewer than ``max_bins``) and written as blocks of ``BLOCK_ROWS`` rows.  A missing value has a bin
of its own and goes to the side where it gains more.

*Lockstep.*  Any number of ensembles (folds of a search, trials, the final fit) grow together
on the same blocks: one Spark job a level for all of them.  Tasks turn their blocks into sparse
histograms per (ensemble, node, feature), these are dealt out by that key, summed and scanned for
the feature's best split, and the driver sees one row per (ensemble, node, feature), whatever the number of
rows.  Longer ensembles whose rows fill one block at most are dealt out to tasks, which grow them whole.  Every ``REFRESH`` trees the predictions are written beside the blocks, so a
task never evaluates more than that many trees and lineage stays short.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.session import checkpoint_dir

BLOCK_ROWS = 1 << 15
MAX_BINS = 256
REFRESH = 16
TREES_A_WRITE = 1024        # trees sent to a task that writes predictions
TREES_A_JOB = 1 << 14       # trees that a job sends to the driver
MIN_GAIN = 1e-6             # a split must gain more than rounding noise
SEED = 42
HISTOGRAM = "job int, node int, feature int, src long, bins array<int>, g array<double>, h array<double>"
SPLIT = ("job int, node int, feature int, bin int, missing_left boolean, gain double, "
         "gl double, hl double, g double, h double")
BLOCK = "block binary, y binary, period binary, rid binary, n int, margin binary"


@dataclass
class Tree:
    """Nodes in the order they were made; a leaf has feature -1."""
    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, weight: float) -> int:
        for name, v in (("feature", -1), ("bin", 0), ("missing_left", False), ("left", -1), ("right", -1),
                        ("weight", weight), ("gain", 0.0)):
            getattr(self, name).append(v)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, b: int, missing_left: bool, gain: float, wl: float, wr: float):
        self.feature[node], self.bin[node], self.missing_left[node], self.gain[node] = feature, b, missing_left, gain
        self.left[node], self.right[node] = self.add(wl), self.add(wr)
        return self.left[node], self.right[node]

    def prune(self, gamma: float, node: int = 0) -> None:
        """Take back, from the bottom up, splits into two leaves that gain less than ``gamma``."""
        if self.feature[node] < 0:
            return
        left, right = self.left[node], self.right[node]
        self.prune(gamma, left)
        self.prune(gamma, right)
        if self.feature[left] < 0 and self.feature[right] < 0 and self.gain[node] < gamma:
            self.feature[node], self.gain[node] = -1, 0.0

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """Node of every row of a binned matrix (rows x features)."""
        feature, at, left, right = (np.array(x) for x in (self.feature, self.bin, self.left, self.right))
        missing_left = np.array(self.missing_left)
        node = np.zeros(len(bins), np.int64)
        live = np.arange(len(bins))
        while True:
            live = live[feature[node[live]] >= 0]
            if not len(live):
                return node
            cur = node[live]
            b = bins[live, feature[cur]]
            go_left = np.where(b == 0, missing_left[cur], b <= at[cur])
            node[live] = np.where(go_left, left[cur], right[cur])

    def values(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.weight)[self.leaf_of(bins)]


@dataclass
class Ensemble:
    """Parameters of one ensemble, the last period it trains on (None: all rows), and its trees."""
    params: dict
    until: float | None = None
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def predict(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for t in self.trees:
            out += t.values(bins)
        return out


# ---------------------------------------------------------------- bins and blocks
def bin_borders(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper borders of every feature's bins: up to ``max_bins - 1`` quantiles, from one aggregate."""
    probs = [i / max_bins for i in range(1, max_bins)]
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), probs,
                                       100 * max_bins).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(q or [], float)) for q in row]


def binned(x: np.ndarray, borders: list[np.ndarray]) -> np.ndarray:
    """Bin of every value: 0 for missing, else 1 + number of borders below it."""
    out = np.zeros(x.shape, np.int32)
    for j, b in enumerate(borders):
        out[:, j] = np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(b, x[:, j], "left"))
    return out


def _blocks(k: int, borders: list[np.ndarray]):
    def run(batches):
        parts, held = [], 0

        def flush():
            x, y, period, rid = (np.concatenate(c) for c in zip(*parts))
            raw = [binned(x, borders).astype(np.uint16 if max(map(len, borders), default=0) < 65535 else np.int32),
                   y, period, rid]
            return pa.RecordBatch.from_arrays(
                [*[pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in raw],
                 pa.array([len(y)], pa.int32()), pa.array([b""], pa.binary())], [c.split()[0] for c in BLOCK.split(", ")])
        for batch in batches:
            if not batch.num_rows:
                continue
            col = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(k + 3)]
            parts.append((np.column_stack(col[:k]).astype(float) if k else np.zeros((batch.num_rows, 0)),
                          col[k].astype(float), col[k + 1].astype(float), col[k + 2].astype(np.int64)))
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                yield flush()
                parts, held = [], 0
        if held:
            yield flush()
    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/boosting-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def row_blocks(df: DataFrame, features: Sequence[str], label: str, borders: list[np.ndarray],
               period: str | None = None, key_cols: Sequence[str] = ()) -> DataFrame:
    """Binned rows of ``df`` with a label, as blocks, written once."""
    key = F.xxhash64(F.lit(SEED), *(key_cols or [*features, label]))
    rows = df.where(F.col(label).isNotNull()).select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"),
        (F.col(period).cast("double") if period else F.lit(0.0)).alias("period"), key.alias("rid"))
    tasks = -(-rows.count() // BLOCK_ROWS)
    if tasks < rows.rdd.getNumPartitions():
        rows = rows.coalesce(max(1, tasks))             # a task a block, no empty ones
    return _written(rows.mapInArrow(_blocks(len(features), borders), BLOCK), "rows")


def _open(batch: pa.RecordBatch, k: int):
    """Blocks of a batch: binned matrix, labels, periods, row hashes, margins (ensembles x rows, or None)."""
    for r in batch.to_pylist():
        kind = np.uint16 if len(r["block"]) == 2 * k * r["n"] else np.int32
        bins = np.frombuffer(r["block"], kind).reshape(r["n"], k).astype(np.int32)
        margin = np.frombuffer(r["margin"]).reshape(-1, r["n"]) if r["margin"] else None
        yield bins, np.frombuffer(r["y"]), np.frombuffer(r["period"]), np.frombuffer(r["rid"], np.uint64), margin, r


# ---------------------------------------------------------------- one level
def gain_term(g, h, alpha: float, lam: float):
    """T(G)^2 / (H + lambda)."""
    t = np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)
    return t * t / np.maximum(h + lam, 1e-300)


def leaf_weight(g: float, h: float, p: dict) -> float:
    t = np.sign(g) * max(abs(g) - float(p.get("reg_alpha", 0.0)), 0.0)
    return float(-t / max(h + float(p.get("reg_lambda", 1.0)), 1e-300) * float(p.get("learning_rate", 0.3)))


def drawn(rid: np.ndarray, tree: int, share: float) -> np.ndarray:
    """Rows that take part in a tree: a hash of row and tree below ``share``."""
    if share >= 1.0:
        return np.ones(len(rid), bool)
    x = rid + np.uint64((tree * 0x9E3779B97F4A7C15 + 1) % 2 ** 64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(33)
    return (x >> np.uint64(11)).astype(float) / 2.0 ** 53 < share


def tree_columns(k: int, tree: int, share: float) -> np.ndarray:
    n = max(1, int(share * k))
    return np.arange(k) if n >= k else np.sort(np.random.default_rng([SEED, tree]).choice(k, n, replace=False))


def _margins(e: Ensemble, since: int, margin, j: int, bins: np.ndarray) -> np.ndarray:
    out = np.full(len(bins), e.base) if margin is None else margin[j].copy()
    for t in e.trees[since:]:
        out += t.values(bins)
    return out


def _histograms(ensembles: list[Ensemble], since: int, tree_no: int, current: dict, frontier: dict, k: int):
    """Sparse histograms of every frontier node of every growing ensemble, over a task's blocks."""
    def run(batches):
        found: dict = {}
        width = 0
        for batch in batches:
            for bins, y, period, rid, margin, _ in _open(batch, k):
                width = max(width, int(bins.max(initial=0)) + 1)
                for j, nodes in frontier.items():
                    e = ensembles[j]
                    use = drawn(rid, tree_no, float(e.params.get("subsample", 1.0)))
                    if e.until is not None:
                        use = use & (period <= e.until)
                    rows = np.flatnonzero(use)
                    place = np.full(len(current[j].feature), -1)
                    place[nodes] = np.arange(len(nodes))
                    at = place[current[j].leaf_of(bins[rows])]
                    rows, at = rows[at >= 0], at[at >= 0]
                    if not len(rows):
                        continue
                    g = _margins(e, since, margin, j, bins[rows] if margin is None else bins)
                    g = (g if margin is None else g[rows]) - y[rows]
                    cols = tree_columns(k, tree_no, float(e.params.get("colsample_bytree", 1.0)))
                    key = ((at[:, None] * k + cols[None, :]) << 32 | bins[rows][:, cols]).ravel()
                    key, inv = np.unique(key, return_inverse=True)
                    found.setdefault(j, []).append((key, np.bincount(inv, np.repeat(g, len(cols))), np.bincount(inv).astype(float)))
        src = TaskContext.get().partitionId()
        for j, parts in found.items():
            key, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            g = np.bincount(inv, np.concatenate([p[1] for p in parts]))
            h = np.bincount(inv, np.concatenate([p[2] for p in parts]))
            group, first = np.unique(key >> 32, return_index=True)
            offs = pa.array(np.append(first, len(key)).astype(np.int32))
            nodes = np.array(frontier[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(group), j, np.int32)), pa.array(nodes[group // k].astype(np.int32)),
                 pa.array((group % k).astype(np.int32)), pa.array(np.full(len(group), src, np.int64)),
                 pa.ListArray.from_arrays(offs, pa.array((key & 0xFFFFFFFF).astype(np.int32))),
                 pa.ListArray.from_arrays(offs, pa.array(g)), pa.ListArray.from_arrays(offs, pa.array(h))],
                ["job", "node", "feature", "src", "bins", "g", "h"])
    return run


def best_split(b: np.ndarray, g: np.ndarray, h: np.ndarray, p: dict):
    """Best border of one feature in one node from its summed histogram (bins ascending):
    (bin, missing goes left, gain, G left, H left), gain -inf without a valid split."""
    alpha, lam = float(p.get("reg_alpha", 0.0)), float(p.get("reg_lambda", 1.0))
    least = float(p.get("min_child_weight", 1.0))
    tg, th = float(g.sum()), float(h.sum())
    miss = b == 0
    mg, mh = float(g[miss].sum()), float(h[miss].sum())
    b, cg, ch = b[~miss], np.cumsum(g[~miss]), np.cumsum(h[~miss])
    best = (0, False, -np.inf, 0.0, 0.0)
    for left in ((False, True) if mh > 0 else (False,)):
        gl, hl = (cg + mg, ch + mh) if left else (cg, ch)
        gr, hr = tg - gl, th - hl
        gain = gain_term(gl, hl, alpha, lam) + gain_term(gr, hr, alpha, lam) - gain_term(tg, th, alpha, lam)
        gain = np.where((hl >= max(least, 1e-12)) & (hr >= max(least, 1e-12)), gain, -np.inf)
        if len(gain):
            i = int(np.argmax(gain))
            if gain[i] > best[2]:
                best = (int(b[i]), left, float(gain[i]), float(gl[i]), float(hl[i]))
    return best, tg, th


def _splits(params: dict):
    """Histogram rows dealt by (job, node, feature) -> one best split each."""
    def run(batches):
        got: dict = {}
        for batch in batches:
            c = [batch.column(i).to_pylist() for i in range(4)]
            lists = [batch.column(i) for i in (4, 5, 6)]
            for i, (job, node, feature, src) in enumerate(zip(*c)):
                got.setdefault((job, node, feature), []).append((src, *[x[i].values.to_numpy(zero_copy_only=False) for x in lists]))
        rows = []
        for (job, node, feature), parts in sorted(got.items()):
            parts.sort(key=lambda p: p[0])                  # one order of summation, whatever task came first
            b, inv = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
            g = np.bincount(inv, np.concatenate([p[2] for p in parts]))
            h = np.bincount(inv, np.concatenate([p[3] for p in parts]))
            (at, left, gain, gl, hl), tg, th = best_split(b, g, h, params[job])
            rows.append((job, node, feature, at, left, gain, gl, hl, tg, th))
        if rows:
            kinds = [pa.int32()] * 4 + [pa.bool_()] + [pa.float64()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)],
                                             [c.split()[0] for c in SPLIT.split(", ")])
    return run


def _refreshed(ensembles: list[Ensemble], since: int, k: int):
    """Blocks with the predictions of all trees so far."""
    def run(batches):
        for batch in batches:
            for bins, _, _, _, margin, r in _open(batch, k):
                m = np.vstack([_margins(e, since, margin, j, bins) for j, e in enumerate(ensembles)])
                r["margin"] = m.tobytes()
                yield pa.RecordBatch.from_pylist([r], pa.schema([
                    ("block", pa.binary()), ("y", pa.binary()), ("period", pa.binary()), ("rid", pa.binary()),
                    ("n", pa.int32()), ("margin", pa.binary())]))
    return run


def _level(blocks: DataFrame, one_task: bool, histograms, splits) -> DataFrame:
    if one_task:
        return blocks.mapInArrow(lambda batches: splits(histograms(batches)), SPLIT)
    return blocks.mapInArrow(histograms, HISTOGRAM).repartition("job", "node", "feature").mapInArrow(splits, SPLIT)


def _one_tree(ensembles: list[Ensemble], t: int, level) -> None:
    """Tree ``t`` of every ensemble that has one, level by level; ``level(current, frontier)`` gives the best splits
    of the frontier's nodes, a row per (ensemble, node, feature)."""
    active = [j for j, e in enumerate(ensembles) if int(e.params.get("n_estimators", 100)) > t]
    current = {j: Tree() for j in active}
    for j in active:
        current[j].add(0.0)
    frontier = {j: [0] for j in active}
    depth = 0
    while frontier:
        per: dict = {}
        for r in level(current, frontier):
            per.setdefault((r["job"], r["node"]), []).append(r)
        depth += 1
        following: dict = {}
        for (j, node), options in per.items():
            p, tree = ensembles[j].params, current[j]
            best = min(options, key=lambda r: (-r["gain"], r["feature"]))
            if node == 0:
                tree.weight[0] = leaf_weight(best["g"], best["h"], p)
            if best["gain"] > MIN_GAIN:
                gr, hr = best["g"] - best["gl"], best["h"] - best["hl"]
                made = tree.split(node, best["feature"], best["bin"], best["missing_left"], best["gain"],
                                  leaf_weight(best["gl"], best["hl"], p), leaf_weight(gr, hr, p))
                if depth < int(p.get("max_depth", 6)):
                    following.setdefault(j, []).extend(made)
        frontier = following
    for j in active:
        current[j].prune(float(ensembles[j].params.get("gamma", 0.0)))
        ensembles[j].trees.append(current[j])


def _whole(ensembles: list[Ensemble], k: int):
    """(job, the only block) -> (job, its trees): every tree of an ensemble, predictions kept beside the block."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                j = r.pop("job")
                own = [Ensemble(ensembles[j].params, ensembles[j].until, ensembles[j].base)]
                params = {0: own[0].params}
                bins = next(_open(pa.RecordBatch.from_pylist([r]), k))[0]
                margin = np.full(len(bins), own[0].base)
                for t in range(int(own[0].params.get("n_estimators", 100))):
                    block = pa.RecordBatch.from_pylist([{**r, "margin": margin.tobytes()}])

                    def level(current, frontier):
                        grown = _histograms(own, t, t, current, frontier, k)([block])
                        return [row for part in _splits(params)(grown) for row in part.to_pylist()]
                    _one_tree(own, t, level)
                    margin += own[0].trees[-1].values(bins)
                yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), pa.array([json.dumps(_tree_lists(own[0]))])],
                                                 ["job", "trees"])
    return run


def grow(blocks: DataFrame, k: int, ensembles: list[Ensemble], refresh: int = REFRESH) -> DataFrame:
    """Grow all ensembles in lockstep; returns the blocks with their final predictions.

    Rows that fill no more than one block have nothing to be summed over tasks: there ensembles of more than ``refresh``
    trees are dealt out instead, and a task grows all trees of its own, in one job for all of them instead of one a level.
    Base value: the mean label of the ensemble's training rows."""
    for e, mean in zip(ensembles, _base_values(blocks, k, [e.until for e in ensembles])):
        e.base, e.trees = mean, []
    rounds = max((int(e.params.get("n_estimators", 100)) for e in ensembles), default=0)
    since = 0
    if rounds > refresh and blocks.limit(2).count() == 1:
        spark = blocks.sparkSession
        bare = [Ensemble(e.params, e.until, e.base) for e in ensembles]
        count = np.cumsum([int(e.params.get("n_estimators", 100)) for e in ensembles]) // TREES_A_JOB
        for some in [np.flatnonzero(count == c).tolist() for c in np.unique(count)]:
            jobs = spark.range(some[0], some[-1] + 1, 1, min(len(some), 4 * spark.sparkContext.defaultParallelism))
            dealt = jobs.select(F.col("id").cast("int").alias("job")).crossJoin(F.broadcast(blocks))
            for r in dealt.mapInArrow(_whole(bare, k), "job int, trees string").collect():
                ensembles[r["job"]].trees = _trees_of(json.loads(r["trees"]))
        step = max(refresh, TREES_A_WRITE // max(1, len(ensembles)))
        for since in range(0, rounds - step, step):
            part = [Ensemble(e.params, e.until, e.base, e.trees[since:since + step]) for e in ensembles]
            blocks = _written(blocks.mapInArrow(_refreshed(part, 0, k), BLOCK), "margins")
        since = len(range(0, rounds - step, step)) * step
        return _written(blocks.mapInArrow(_refreshed(_since(ensembles, since), 0, k), BLOCK), "margins")
    one_task = blocks.rdd.getNumPartitions() == 1       # its histograms are whole already
    params = {j: e.params for j, e in enumerate(ensembles)}
    for t in range(rounds):
        if t - since >= refresh:
            blocks = _written(blocks.mapInArrow(_refreshed(_since(ensembles, since), 0, k), BLOCK), "margins")
            since = t
        late = _since(ensembles, since)

        def level(current, frontier):
            return _level(blocks, one_task, _histograms(late, 0, t, current, frontier, k), _splits(params)).collect()
        _one_tree(ensembles, t, level)
    return _written(blocks.mapInArrow(_refreshed(_since(ensembles, since), 0, k), BLOCK), "margins")


def _since(ensembles: list[Ensemble], since: int) -> list[Ensemble]:
    """The ensembles with the trees that the blocks' predictions lack: all that a task needs of them."""
    return [Ensemble(e.params, e.until, e.base, e.trees[since:]) for e in ensembles]


def _base_values(blocks: DataFrame, k: int, untils: list) -> list[float]:
    def run(batches):
        n, s = np.zeros(len(untils)), np.zeros(len(untils))
        for batch in batches:
            for _, y, period, _, _, _ in _open(batch, k):
                for j, until in enumerate(untils):
                    own = y if until is None else y[period <= until]
                    n[j] += len(own)
                    s[j] += own.sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(untils)), pa.int32()), pa.array(n), pa.array(s)], ["job", "n", "s"])
    got = {r["job"]: r for r in blocks.mapInArrow(run, "job int, n double, s double").groupBy("job")
           .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()}
    return [float(got[j]["s"] / got[j]["n"]) if j in got and got[j]["n"] else 0.0 for j in range(len(untils))]


def fold_scores(blocks: DataFrame, k: int, windows: list[tuple[float, float]]) -> list[float]:
    """R2 of every ensemble on the rows of its window of periods (lo..hi), from the blocks that ``grow``
    returned; one aggregate."""
    def run(batches):
        for batch in batches:
            rows = []
            for _, y, period, _, margin, _ in _open(batch, k):
                for j, (lo, hi) in enumerate(windows):
                    at = (period >= lo) & (period <= hi)
                    rows.append((j, float(at.sum()), float(y[at].sum()), float((y[at] ** 2).sum()),
                                 float(((y[at] - margin[j][at]) ** 2).sum())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["job", "n", "s", "ss", "sse"])
    got = {r["job"]: r for r in blocks.mapInArrow(run, "job long, n double, s double, ss double, sse double").groupBy("job").agg(
        *[F.sum(c).alias(c) for c in ("n", "s", "ss", "sse")]).collect()}
    out = []
    for j in range(len(windows)):
        r = got.get(j)
        sst = r["ss"] - r["s"] ** 2 / r["n"] if r and r["n"] else 0.0
        out.append(float(1 - r["sse"] / sst) if sst > 0 else float("nan"))
    return out


# ---------------------------------------------------------------- fitted model
def importances(e: Ensemble, k: int) -> list[float]:
    """Mean gain of a feature's splits, scaled to sum 1 (0 for features never used)."""
    total, n = np.zeros(k), np.zeros(k)
    for t in e.trees:
        # nodes below a pruned split are no longer reached
        todo = [0]
        while todo:
            x = todo.pop()
            if t.feature[x] >= 0:
                total[t.feature[x]] += t.gain[x]
                n[t.feature[x]] += 1
                todo += [t.left[x], t.right[x]]
    mean = np.divide(total, n, out=np.zeros(k), where=n > 0)
    return (mean / mean.sum() if mean.sum() > 0 else mean).tolist()


def _tree_lists(e: Ensemble) -> list[dict]:
    return [{f: list(map(float if f in ("weight", "gain") else int, getattr(t, f))) for f in t.__dataclass_fields__}
            for t in e.trees]


def _trees_of(lists: list[dict]) -> list[Tree]:
    return [Tree(**{**t, "missing_left": [bool(x) for x in t["missing_left"]]}) for t in lists]


def to_state(e: Ensemble, borders: list[np.ndarray]) -> dict:
    return {"base": e.base, "borders": [b.tolist() for b in borders], "trees": _tree_lists(e)}


def from_state(state: dict, params: dict) -> tuple[Ensemble, list[np.ndarray]]:
    return Ensemble(params, None, state["base"], _trees_of(state["trees"])), [np.array(b, float) for b in state["borders"]]


def predict(df: DataFrame, features: Sequence[str], e: Ensemble, borders: list[np.ndarray], out: str = "y_pred") -> DataFrame:
    """Adds the ensemble's prediction, one vectorised expression per Arrow batch; missing features are allowed."""
    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in cols])
        return pd.Series(e.predict(binned(x, borders)))
    return df.withColumn(out, score(*[F.col(c).cast("double") for c in features]))


def fit(train: DataFrame, features: Sequence[str], label: str, params: dict, key_cols: Sequence[str] = (),
        max_bins: int = MAX_BINS) -> tuple[Ensemble, list[np.ndarray]]:
    """One ensemble on all rows of ``train``."""
    borders = bin_borders(train, features, max_bins)
    blocks = row_blocks(train, features, label, borders, None, key_cols)
    e = Ensemble(dict(params))
    grow(blocks, len(features), [e])
    return e, borders


def walk_forward_scores(train: DataFrame, features: Sequence[str], label: str, period: str, folds: list, params: list[dict],
                        key_cols: Sequence[str] = (), max_bins: int = MAX_BINS, refit: dict | None = None):
    """R2 per parameter set and fold (train end, first and last validation period): all ensembles
    grow on the same blocks, one job a level for all of them.  With parameters ``refit`` an ensemble on all
    rows, the one of ``fit``, grows beside them: returns (scores, ensemble, borders)."""
    borders = bin_borders(train, features, max_bins)
    blocks = row_blocks(train, features, label, borders, period, key_cols)
    ensembles = [Ensemble(dict(p), float(end)) for p in params for end, _, _ in folds]
    windows = [(float(lo), float(hi)) for _ in params for _, lo, hi in folds]
    whole = [] if refit is None else [Ensemble(dict(refit))]
    got = fold_scores(grow(blocks, len(features), ensembles + whole), len(features), windows)
    scores = [got[i * len(folds):(i + 1) * len(folds)] for i in range(len(params))]
    return scores if refit is None else (scores, whole[0], borders)
