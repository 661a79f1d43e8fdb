from panelspark.operators import splits


def test_temporal_split_drops_null_time(spark):
    df = spark.createDataFrame([(1, 2016), (2, 2017), (3, 2018), (4, None)], "id int, t int")
    out = {r.id: r.split for r in splits.temporal_split(df, "t", 2017).collect()}
    assert out == {1: "train", 2: "train", 3: "test"}


def test_panel_split_modes(spark):
    df = spark.createDataFrame([(t,) for t in range(2000, 2010)], "t int")
    def n_test(**kw):
        return splits.panel_split(df, "t", **kw).where("split = 'test'").count()
    assert n_test(train_end=2006) == 3
    assert n_test(test_periods=4) == 4
    assert n_test(test_ratio=0.2) == 2
    assert n_test(test_ratio=0.01) == 1          # at least one period


def test_walk_forward_folds(spark):
    df = spark.createDataFrame([(t,) for t in range(2000, 2012) for _ in range(2)], "t int")
    f = splits.walk_forward_folds(df, "t", min_train=8, valid=1).collect()
    folds = sorted({r.fold for r in f})
    assert folds == [0, 1, 2, 3]
    for i in folds:
        tr = sorted(r.t for r in f if r.fold == i and r.role == "train")
        va = [r.t for r in f if r.fold == i and r.role == "valid"]
        assert tr == list(range(2000, 2008 + i)) and va == [2008 + i]


def test_walk_forward_too_few_periods(spark):
    import pytest
    df = spark.createDataFrame([(t,) for t in range(5)], "t int")
    with pytest.raises(ValueError):
        splits.walk_forward_folds(df, "t", min_train=8)


def test_default_min_train():
    assert splits.default_min_train(28, 5) == 8
    assert splits.default_min_train(10, 5) == 5
    assert splits.default_min_train(12, 5) == 7


def test_contiguous_folds_sizes(spark):
    df = spark.range(23).withColumnRenamed("id", "k")
    f = splits.contiguous_folds(df, ["k"], 5).collect()
    sizes = [sum(1 for r in f if r.fold == i) for i in range(5)]
    assert sizes == [5, 5, 5, 4, 4]
    assert all(r.fold == min(i // 5 if i < 15 else 3 + (i - 15) // 4, 4) for i, r in enumerate(sorted(f, key=lambda r: r.k)))


def test_hash_folds_deterministic(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    a = [r.fold for r in splits.hash_folds(df, ["k"], 5).orderBy("k").collect()]
    b = [r.fold for r in splits.hash_folds(df.repartition(7), ["k"], 5).orderBy("k").collect()]
    assert a == b and set(a) == {0, 1, 2, 3, 4}


def test_contiguous_folds_are_exact_on_many_rows(spark):
    from pyspark.sql import functions as F
    n = 1_000_003
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(n)).alias("k"), "id", (F.col("id") * 3).alias("x"),
                               F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(9)
    f = splits.contiguous_folds(df, ["k", "id"], 5)
    rows = f.groupBy("fold").agg(F.count("*").alias("n"), F.min(F.struct("k", "id")).alias("lo"),
                                 F.max(F.struct("k", "id")).alias("hi")).orderBy("fold").collect()
    assert [r.n for r in rows] == [200001, 200001, 200001, 200000, 200000]
    assert all(tuple(a.hi) < tuple(b.lo) for a, b in zip(rows, rows[1:]))
