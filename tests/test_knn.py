import numpy as np
import pandas as pd
import pytest

from panelspark.operators import knn


@pytest.mark.parametrize("p,block", [(2, 1 << 30), (1, 1 << 30), (3, 2000)])
def test_knn_join_matches_bruteforce(spark, p, block):
    rng = np.random.default_rng(p)
    X = rng.normal(size=(120, 4))
    y = rng.normal(size=120)
    pdf = pd.DataFrame({"id": np.arange(120), **{f"f{i}": X[:, i] for i in range(4)}, "y": y})
    df = spark.createDataFrame(pdf)
    feats = [f"f{i}" for i in range(4)]
    q = df.select("id", *feats).withColumnRenamed("id", "qid")
    r = df.select("id", *feats, "y").withColumnRenamed("id", "rid")
    got = knn.knn_join(q, r, "qid", "rid", feats, k=4, p=p, exclude_self=True, carry=["y"],
                       max_block_bytes=block).toPandas()
    D = (np.abs(X[:, None, :] - X[None, :, :]) ** p).sum(axis=2) ** (1 / p)
    np.fill_diagonal(D, np.inf)
    for qi in range(120):
        exp = np.lexsort((np.arange(120), D[qi]))[:4]
        g = got[got.qid == qi].sort_values("rank")
        assert list(g.rid) == list(exp)
        assert np.allclose(g.distance, D[qi, exp])
    pred = knn.knn_regress(q, r, "qid", "rid", feats, "y", k=4, p=p, exclude_self=True).toPandas().set_index("qid")
    assert pred.loc[0, "y_pred"] == pytest.approx(y[np.lexsort((np.arange(120), D[0]))[:4]].mean())


def test_knn_array_column(spark):
    rows = [(i, [float(i), 0.0]) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    q = df.withColumnRenamed("id", "q")
    got = knn.knn_join(q, df.withColumnRenamed("id", "r"), "q", "r", "v", k=2, exclude_self=True).toPandas()
    assert sorted(got[got.q == 0].r) == [1, 2]
    assert sorted(got[got.q == 5].r) == [4, 6]


@pytest.mark.parametrize("block", [1 << 30, 600])
def test_knn_euclid_ties_match_bruteforce(spark, block):
    """Integer grid points give many equal distances and exact duplicates:
    the screened Euclidean path must keep every tie and break it by id."""
    rng = np.random.default_rng(7)
    X = rng.integers(0, 4, size=(90, 3)).astype(float)
    pdf = pd.DataFrame({"id": np.arange(90) * 3 + 1, **{f"f{i}": X[:, i] for i in range(3)}})
    df = spark.createDataFrame(pdf)
    feats = ["f0", "f1", "f2"]
    got = knn.knn_join(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "rid"), "qid", "rid",
                       feats, k=6, p=2, exclude_self=True, max_block_bytes=block).toPandas()
    ids = pdf.id.to_numpy()
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(D, np.inf)
    for i in range(90):
        exp = np.lexsort((ids, D[i]))[:6]
        g = got[got.qid == ids[i]].sort_values("rank")
        assert list(g.rid) == list(ids[exp])
        assert np.array_equal(g.distance.to_numpy(), D[i, exp])


@pytest.mark.parametrize("p", [1, 2, 3])
def test_pivots_prune_and_stay_exact(spark, p):
    """Low-dimensional rows in clusters, one of them with a third of all rows and many copies: exact, and
    most cells are never visited."""
    rng = np.random.default_rng(p)
    X = np.vstack([rng.normal(size=(400, 3)) * 0.2 + c for c in rng.uniform(-20, 20, size=(10, 3))])
    X[:1300] = np.round(X[:1300] * 2) / 2                        # ties and equal rows
    pdf = pd.DataFrame({"id": rng.permutation(len(X)), "x": X[:, 0], "y": X[:, 1], "z": X[:, 2]})
    df = spark.createDataFrame(pdf).repartition(6)
    feats, stats = ["x", "y", "z"], {}
    q = df.where("id % 20 = 0").withColumnRenamed("id", "__q")       # names near the ones used inside
    got = knn.knn_join(q, df.withColumnRenamed("id", "__r"), "__q", "__r", feats, k=7, p=p, exclude_self=True,
                       max_block_bytes=8000, stats=stats).toPandas().rename(columns={"__q": "q", "__r": "r"})
    ids, M = pdf.id.to_numpy(), pdf[feats].to_numpy()
    for i in np.flatnonzero(ids % 20 == 0):
        D = knn._minkowski(M[i:i + 1], M, p)[0]
        D[i] = np.inf
        exp = np.lexsort((ids, D))[:7]
        g = got[got.q == ids[i]].sort_values("rank")
        assert list(g.r) == list(ids[exp]) and np.allclose(g.distance, D[exp])
    assert stats["pairs"] < 0.25 * stats["all"]


def test_probe_is_approximate_with_high_recall(spark):
    rng = np.random.default_rng(5)
    X = np.vstack([rng.normal(size=(150, 8)) * 0.4 + c for c in rng.uniform(-3, 3, size=(12, 8))])
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(X)), "v": list(X)}), "id long, v array<double>")
    args = (df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "r"), "q", "r", "v")
    want = {(r.q, r.r) for r in knn.knn_join(*args, k=5, exclude_self=True).collect()}
    stats = {}
    some = {(r.q, r.r) for r in knn.knn_join(*args, k=5, exclude_self=True, probe=8, stats=stats).collect()}
    assert len(some & want) / len(want) >= 0.9 and stats["pairs"] < 0.5 * stats["all"]


def test_pivots_with_few_rows(spark):
    df = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(40)], "id long, v array<double>")
    got = knn.knn_join(df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "r"), "q", "r", "v", k=60, exclude_self=True,
                       max_block_bytes=200)
    assert got.count() == 40 * 39
    assert knn.knn_join(df.limit(0).withColumnRenamed("id", "q"), df.withColumnRenamed("id", "r"), "q", "r", "v",
                        max_block_bytes=200).count() == 0


def test_pivots_send_a_query_once_to_a_shard(spark, monkeypatch):
    """Rows without structure, small blocks: every cell is visited, yet a query travels once per shard, not once
    per cell and block, and the result stays exact."""
    rng = np.random.default_rng(11)
    X = rng.normal(size=(600, 24)).astype(np.float32).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(600), "v": list(X)}), "id long, v array<double>")
    sent = []
    monkeypatch.setattr(knn, "cut_lineage", lambda d, cut=knn.cut_lineage: sent.append(cut(d)) or sent[-1])
    got = knn.knn_join(df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "r"), "q", "r", "v", k=5, exclude_self=True,
                       max_block_bytes=16 * 26 * 8).toPandas()
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(D, np.inf)
    for i in range(600):
        assert list(got[got.q == i].sort_values("rank").r) == list(np.lexsort((np.arange(600), D[i]))[:5])
    visits = [d.count() for d in sent if "q" in d.columns and "r" not in d.columns]
    assert max(visits) <= 600                            # one shard holds all cells


def test_pivots_over_many_shards_with_a_hot_cell(spark, monkeypatch):
    """Shards smaller than a cell of equal rows: the cell is dealt over several; ids that repeat stay exact."""
    monkeypatch.setattr(knn, "SHARD_BYTES", 1)
    rng = np.random.default_rng(3)
    X = np.vstack([np.zeros((200, 3)), rng.normal(size=(300, 3))])
    ids = np.concatenate([np.arange(490), np.arange(10)])
    df = spark.createDataFrame(pd.DataFrame({"id": ids, "v": list(X)}), "id long, v array<double>")
    args = (df.where("id >= 10").withColumnRenamed("id", "q"), df.withColumnRenamed("id", "r"), "q", "r", "v")
    rows = lambda d: sorted((r.q, r["rank"], r.r, round(r.distance, 9)) for r in d.collect())
    assert rows(knn.knn_join(*args, k=4, exclude_self=True, max_block_bytes=40 * 24)) == rows(knn.knn_join(*args, k=4, exclude_self=True))
