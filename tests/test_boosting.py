"""Regularised boosting (I3) against a plain recomputation."""

import numpy as np
import pandas as pd
import pytest

from panelspark.operators import boosting, models

P = {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0, "gamma": 0.0,
     "min_child_weight": 1, "reg_alpha": 0.0, "reg_lambda": 1.0}
FEATS = ["a", "b", "c"]


def data(n=240, missing=0.0, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 9, n), rng.uniform(-2, 5, n)]).astype(float)
    y = 3 * np.sin(x[:, 0]) + x[:, 1] * 0.5 + rng.normal(size=n)
    x[rng.random(x.shape) < missing] = np.nan
    return x, y


def plain(x, y, p):
    """Exact greedy boosting: predictions after all rounds, every distinct value a candidate border."""
    soft = lambda g: np.sign(g) * max(abs(g) - p["reg_alpha"], 0)                          # noqa: E731
    worth = lambda g, h: soft(g) ** 2 / (h + p["reg_lambda"])                              # noqa: E731
    pred = np.full(len(y), y.mean())
    for _ in range(p["n_estimators"]):
        g = pred - y

        def build(rows, depth):
            """(node, its update per row): a leaf is ('leaf', weight)."""
            tg, th = g[rows].sum(), len(rows)
            leaf = ("leaf", rows, -soft(tg) / (th + p["reg_lambda"]) * p["learning_rate"])
            best = None
            if depth < p["max_depth"]:
                for f in range(x.shape[1]):
                    v = x[rows, f]
                    for side in ((False, True) if np.isnan(v).any() else (False,)):
                        for cut in np.unique(v[~np.isnan(v)]):
                            left = np.where(np.isnan(v), side, v <= cut)
                            hl, hr = left.sum(), (~left).sum()
                            if min(hl, hr) < max(p["min_child_weight"], 1e-12):
                                continue
                            gl = g[rows][left].sum()
                            gain = worth(gl, hl) + worth(tg - gl, hr) - worth(tg, th)
                            if best is None or gain > best[0] + 1e-9:
                                best = (gain, rows[left], rows[~left])
            if best is None or best[0] <= 1e-6:
                return leaf
            a, b = build(best[1], depth + 1), build(best[2], depth + 1)
            if a[0] == b[0] == "leaf" and best[0] < p["gamma"]:
                return leaf
            return ("split", a, b)

        def apply(node):
            if node[0] == "leaf":
                pred[node[1]] += node[2]
            else:
                apply(node[1])
                apply(node[2])
        apply(build(np.arange(len(y)), 0))
    return pred


def frame(spark, x, y):
    pdf = pd.DataFrame(x, columns=FEATS).astype(object).where(~np.isnan(x), None)
    pdf["y"], pdf["k"], pdf["t"] = y, np.arange(len(y)), np.arange(len(y)) // 20
    return spark.createDataFrame(pdf, "a double, b double, c double, y double, k long, t long").repartition(5)


@pytest.mark.parametrize("change,missing", [
    ({}, 0.0), ({"reg_alpha": 4.0, "reg_lambda": 0.3}, 0.0), ({"gamma": 25.0, "min_child_weight": 12}, 0.0),
    ({"reg_lambda": 20.0, "max_depth": 5}, 0.15)])
def test_equals_plain_boosting(spark, change, missing, monkeypatch):
    p = P | change
    x, y = data(missing=missing)
    df = frame(spark, x, y)
    e, borders = boosting.fit(df, FEATS, "y", p, ["k"], max_bins=512)
    got = {r.k: r.y_pred for r in boosting.predict(df, FEATS, e, borders).collect()}
    assert np.allclose([got[i] for i in range(len(y))], plain(x, y, p), atol=1e-8)
    # written margins and kept trees say the same
    blocks = boosting.row_blocks(df, FEATS, "y", borders, "t", ["k"])
    two = [boosting.Ensemble(p), boosting.Ensemble(p, 5.0)]
    done = boosting.grow(blocks, 3, two, refresh=2)
    assert np.allclose(two[0].predict(boosting.binned(x, borders)), [got[i] for i in range(len(y))], atol=1e-8)
    # an ensemble that stops at period 5 equals one that never saw later rows
    alone, own = boosting.fit(df.where("t <= 5"), FEATS, "y", p, ["k"], max_bins=512)
    few = x[:120]
    assert np.allclose(two[1].predict(boosting.binned(few, borders)), alone.predict(boosting.binned(few, own)), atol=1e-8)
    scores = boosting.fold_scores(done, 3, [(0, 99), (6, 7)])
    late = slice(120, 160)
    want = two[1].predict(boosting.binned(x, borders))[late]
    assert scores[1] == pytest.approx(1 - ((y[late] - want) ** 2).sum() / ((y[late] - y[late].mean()) ** 2).sum())


def test_penalties_do_something(spark):
    x, y = data()
    df = frame(spark, x, y)
    size = {}
    for name, change in (("none", {}), ("l1", {"reg_alpha": 40.0}), ("l2", {"reg_lambda": 100.0}), ("gamma", {"gamma": 1e9})):
        m = models.fit("boosted_trees", P | change, df, FEATS, "y", ["k"])
        e, _ = boosting.from_state(m.state, m.params)
        size[name] = max(abs(w) for t in e.trees for w in t.weight[1:]) if name != "gamma" else sum(f >= 0 for t in e.trees for f in t.feature)
    assert size["l1"] < size["none"] and size["l2"] < size["none"] and size["gamma"] == 0


def test_draws_are_the_same_on_any_partitioning(spark):
    x, y = data()
    p = P | {"subsample": 0.7, "colsample_bytree": 0.67}
    df = frame(spark, x, y)
    a, borders = boosting.fit(df, FEATS, "y", p, ["k"])
    b, _ = boosting.fit(df.repartition(2), FEATS, "y", p, ["k"])
    assert np.allclose(a.predict(boosting.binned(x, borders)), b.predict(boosting.binned(x, borders)), atol=1e-9)
    assert len(boosting.tree_columns(3, 0, 0.67)) == 2
    assert 0.6 < boosting.drawn(np.arange(5000).astype(np.uint64), 3, 0.7).mean() < 0.8


def test_borders_and_empty_features(spark):
    df = spark.createDataFrame([(1.0, None, 5.0, 2.0, 1, 1), (1.0, None, float("nan"), 4.0, 2, 1)],
                               "a double, b double, c double, y double, k long, t long")
    assert [b.tolist() for b in boosting.bin_borders(df, FEATS)] == [[1.0], [], [5.0]]
    e, borders = boosting.fit(df, FEATS, "y", P, ["k"])
    got = [r.y_pred for r in boosting.predict(df, FEATS, e, borders).orderBy("k").collect()]
    assert got[0] < 3.0 < got[1]                       # the missing value of c is what tells the rows apart


def test_walk_forward_in_lockstep(spark):
    x, y = data()
    df = frame(spark, x, y)
    folds = models.time_folds(df, "t", 6)
    got = boosting.walk_forward_scores(df, FEATS, "y", "t", folds, [P, P | {"max_depth": 1}], ["k"], max_bins=512)
    assert len(got) == 2 and all(len(s) == len(folds) for s in got)
    end, lo, hi = folds[2]
    e, borders = boosting.fit(df.where(f"t <= {end}"), FEATS, "y", P, ["k"], max_bins=512)
    one = models.r2_score(boosting.predict(df.where(f"t between {lo} and {hi}"), FEATS, e, borders), "y")
    assert got[0][2] == pytest.approx(one, abs=1e-6)


def test_ensembles_of_one_block_grow_whole(spark, monkeypatch):
    """Rows of one block: one job grows all trees, the same ones as level by level; more blocks go level by level."""
    df = spark.createDataFrame([(i, float(i % 10), None if i % 17 == 0 else float(i * 7 % 23), float(i % 6) - i / 40) for i in range(120)],
                               "k long, a double, b double, y double").coalesce(1)
    p = P | {"n_estimators": 20, "subsample": 0.8, "colsample_bytree": 0.6}
    levels, plain = [], boosting._level
    monkeypatch.setattr(boosting, "_level", lambda *a: levels.append(1) or plain(*a))

    def grown(df=df):
        borders = boosting.bin_borders(df, ["a", "b"])
        ensembles = [boosting.Ensemble(p, 60.0), boosting.Ensemble(p | {"n_estimators": 5, "max_depth": 2}), boosting.Ensemble(p, -1.0)]
        blocks = boosting.row_blocks(df, ["a", "b"], "y", borders, "k", ["k"])
        margins = sorted((r["rid"], r["margin"]) for r in boosting.grow(blocks, 2, ensembles).collect())
        return [boosting.to_state(e, borders) for e in ensembles], margins
    whole = grown()
    assert not levels and len(whole[0][0]["trees"]) == 20 and len(whole[0][1]["trees"]) == 5
    monkeypatch.setattr(boosting, "TREES_A_JOB", 3)
    monkeypatch.setattr(boosting, "TREES_A_WRITE", 1)
    assert grown() == whole and not levels
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 40)
    many = grown(df.repartition(3, "k"))
    assert levels and [[t["feature"] for t in e["trees"]] for e in many[0][:2]] == [[t["feature"] for t in e["trees"]] for e in whole[0][:2]]
