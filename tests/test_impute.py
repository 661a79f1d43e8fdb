import pytest

from panelspark.operators.impute import impute_progressive, provenance_counts, remaining_nulls

SCHEMA = "entity string, time int, split string, v double"


def _rows(rows):
    return {(r["entity"], r["time"]): r for r in rows}


@pytest.mark.parametrize("bucket", [None, 4096, 4])
def test_progressive_radii_and_fallback(spark, bucket):
    # A: 2000..2006 = 1, null, 3, -, -, null, 9 (2003/2004 absent); B all null
    data = [("A", 2000, "train", 1.0), ("A", 2001, "train", None), ("A", 2002, "train", 3.0),
            ("A", 2005, "train", None), ("A", 2006, "train", 9.0),
            ("B", 2000, "train", None), ("B", 2001, "train", None)]
    df = spark.createDataFrame(data, SCHEMA)
    out = _rows(impute_progressive(df, "entity", "time", ["v"], with_method=True, time_bucket=bucket).collect())
    assert out[("A", 2001)]["v"] == 2.0 and out[("A", 2001)]["v_method"] == "w1"
    # 2005: +-1 and +-2 hold only 9 (2003/2004 absent); +-4 holds 3 and 9 -> 6
    assert out[("A", 2005)]["v"] == 6.0 and out[("A", 2005)]["v_method"] == "w4"
    # B: no window -> train median of observed values {1, 3, 9} = 3
    assert out[("B", 2000)]["v"] == 3.0 and out[("B", 2000)]["v_method"] == "global"
    assert out[("A", 2000)]["v_method"] == "observed"


def test_radius_four_even_count(spark):
    data = [("A", 2000, "train", 1.0), ("A", 2001, "train", None), ("A", 2002, "train", 3.0),
            ("A", 2005, "train", None), ("A", 2006, "train", 9.0), ("A", 2009, "train", 11.0)]
    out = _rows(impute_progressive(spark.createDataFrame(data, SCHEMA), "entity", "time", ["v"]).collect())
    # 2005 +-4 reaches 2001..2009: 3, 9 and 11 (2009 is exactly 4 away) -> 9
    assert out[("A", 2005)]["v"] == 9.0


def test_duplicates_enter_window_twice(spark):
    data = [("A", 1, "train", 1.0), ("A", 1, "train", 1.0), ("A", 2, "train", None), ("A", 3, "train", 10.0)]
    out = impute_progressive(spark.createDataFrame(data, SCHEMA), "entity", "time", ["v"]).where("time = 2").first()
    assert out["v"] == 1.0          # median(1, 1, 10)


def test_splits_are_separate_and_past_only(spark):
    data = [("A", 1, "train", 1.0), ("A", 2, "train", 2.0), ("A", 3, "test", None), ("A", 4, "test", 10.0),
            ("A", 5, "test", 20.0)]
    df = spark.createDataFrame(data, SCHEMA)
    both = _rows(impute_progressive(df, "entity", "time", ["v"], with_method=True).collect())
    assert both[("A", 3)]["v"] == 15.0 and both[("A", 3)]["v_method"] == "w2"   # test window only: 10, 20
    past = _rows(impute_progressive(df, "entity", "time", ["v"], with_method=True, allow_future=False).collect())
    assert past[("A", 3)]["v"] == 1.5 and past[("A", 3)]["v_method"] == "global"  # train median


def test_provenance_and_remaining(spark):
    data = [("A", 1, "train", 1.0), ("A", 2, "train", None), ("A", 3, "train", 3.0)]
    imp = impute_progressive(spark.createDataFrame(data, SCHEMA), "entity", "time", ["v"], with_method=True)
    prov = {(r["column"], r["method"]): r["n"] for r in provenance_counts(imp, ["v"]).collect()}
    assert prov == {("v", "w1"): 1}
    assert remaining_nulls(imp, ["v"]).first()["remaining_nulls"] == 0


def test_radius_wider_than_a_bucket(spark):
    """The halo reaches over every bucket between: the result does not depend on the bucket."""
    rows = [("A", t, None if t % 6 else float(t * t), "train" if t < 30 else "test") for t in range(50)] + [("B", None, None, "train"), ("B", 3, 2.0, "train")]
    df = spark.createDataFrame(rows, "e string, t int, x double, split string")
    got = [sorted(map(str, impute_progressive(df, "e", "t", ["x"], radii=(1, 5, 13), time_bucket=b).collect())) for b in (None, 2, 3, 4096)]
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) == 52
