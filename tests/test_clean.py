import pytest

from panelspark.functions.scalar import band_score, classify_overfit, try_double
from panelspark.operators import clean


def test_detect_time_columns():
    cols = ["Country Name", "2018", "2019", "2020", "invalid", "text_col", "1899", "2100.0", "Year"]
    assert clean.detect_time_columns(cols) == ["2018", "2019", "2020", "2100.0"]


@pytest.mark.parametrize("name", ["Country", "country", "Country Name"])
def test_standardize_entity(spark, name):
    df = spark.createDataFrame([("X", 2000)], f"`{name}` string, Year int")
    assert clean.standardize_entity(df).columns[0] == "entity"


def test_wide_to_long_keeps_nulls_and_casts(spark):
    df = spark.createDataFrame([("A", "1.5", None), ("B", "n/a", "2")], "e string, `2018` string, `2019` string")
    rows = sorted(clean.wide_to_long(df, ["e"], "v").collect())
    assert [(r.e, r.time, r.v) for r in rows] == [("A", 2018, 1.5), ("A", 2019, None), ("B", 2018, None), ("B", 2019, 2.0)]


def test_missingness_threshold_inclusive(spark):
    # 10 rows, 2 features + time -> 30 cells; 9 missing -> exactly 0.30 -> kept
    rows = [("A", t, None if t < 9 else 1.0, 1.0) for t in range(10)]
    df = spark.createDataFrame(rows, "e string, t int, f1 double, f2 double")
    sh = clean.missing_share(df, "e", ["f1", "f2"]).first()
    assert sh["missing_share"] == pytest.approx(0.30)
    assert clean.filter_missingness(df, "e", ["f1", "f2"]).count() == 10
    # without the time column in the denominator: 9/20 -> dropped
    assert clean.filter_missingness(df, "e", ["f1", "f2"], count_time_as_feature=False).count() == 0


def test_outer_merge_join_equals_pivot_and_code(spark):
    a = spark.createDataFrame([("X", 1, "XC", 1.0), ("Y", 1, "YC", 2.0)], "entity string, time int, code string, a double")
    b = spark.createDataFrame([("X", 1, 5.0), ("Z", 2, 6.0)], "entity string, time int, b double")
    c = spark.createDataFrame([("Z", 2, "ZC", 7.0)], "entity string, time int, code string, c double")
    j = clean.outer_merge([a, b, c], ["entity", "time"], method="join", code_col="code")
    p = clean.outer_merge([a, b, c], ["entity", "time"], method="pivot", code_col="code")
    cols = ["entity", "time", "code", "a", "b", "c"]
    assert sorted(j.select(cols).collect()) == sorted(p.select(cols).collect())
    assert {r.entity: r.code for r in j.collect()} == {"X": "XC", "Y": "YC", "Z": "ZC"}


def test_remap_whitelist_region(spark):
    df = spark.createDataFrame([("Korea, Rep.",), ("France",), ("Atlantis",)], "entity string")
    m = clean.remap_values(df, "entity", {"Korea, Rep.": "South Korea"})
    assert sorted(r.entity for r in m.collect()) == ["Atlantis", "France", "South Korea"]
    assert clean.keep_entities(m, ["France", "South Korea"]).count() == 2
    dim = spark.createDataFrame([("France", "Europe")], "entity string, region string")
    reg = {r.entity: r.region for r in clean.classify_region(m, dim).collect()}
    assert reg["France"] == "Europe" and reg["Atlantis"] == "Other"
    assert {r.entity for r in clean.unmatched_keys(m, dim, "entity").collect()} == {"Atlantis", "South Korea"}


def test_scalar_ladders(spark):
    df = spark.createDataFrame([(-1.5,), (-1.0,), (0.5,), (0.6,), (None,)], "x double")
    bands = [r[0] for r in df.select(band_score("x")).collect()]
    assert bands == ["low", "moderate", "moderate", "high", None]
    gaps = spark.createDataFrame([(0.01,), (0.05,), (0.2,)], "g double")
    assert [r[0] for r in gaps.select(classify_overfit("g")).collect()] == ["good", "moderate", "overfit"]
    t = spark.createDataFrame([("1e3",), ("abc",), ("NaN",)], "s string")
    assert [r[0] for r in t.select(try_double("s")).collect()] == [1000.0, None, None]


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    assert clean.drop_null_columns(df).columns == ["a"]


def test_outer_merge_of_repeated_keys_does_not_depend_on_the_number_of_tables(spark):
    a = spark.createDataFrame([("X", 1, 1.0), ("X", 1, 2.0), (None, 2, 3.0)], "entity string, time int, a double")
    b = spark.createDataFrame([("X", 1, "p"), (None, 2, "q")], "entity string, time int, b string")
    c = spark.createDataFrame([("Y", 3, 7)], "entity string, time int, c int")
    two = clean.outer_merge([a, b], ["entity", "time"])
    three = clean.outer_merge([a, b, c], ["entity", "time"])
    assert sorted(map(str, two.collect())) == sorted(map(str, three.where("c is null").drop("c").collect()))
    assert three.count() == 4 and two.where("entity is null").first().b == "q"
    with pytest.raises(ValueError):
        clean.outer_merge([a, b, c], ["entity", "time"], method="pivot")
    unique = a.where("a <> 2")
    p = clean.outer_merge([unique, b, c], ["entity", "time"], method="pivot")
    j = clean.outer_merge([unique, b, c], ["entity", "time"], method="join").select(p.columns)
    assert p.dtypes == j.dtypes and sorted(map(str, p.collect())) == sorted(map(str, j.collect()))


def test_time_columns_follow_the_number_rule():
    cols = ["2018", " 2019 ", "2020.0", "1899", "2101", "Year", "abc", "20.18", "-2000", "2e3", "nan", "inf"]
    assert clean.detect_time_columns(cols) == ["2018", " 2019 ", "2020.0", "2e3"]
