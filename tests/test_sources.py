import os

import pytest

from panelspark.operators import clean
from panelspark.sources import files, sinks

WIDE = ('"Data Source","World Development Indicators",\n\n"Last Updated Date","2024-01-01",\n\n'
        'Country Name,Country Code,2018,2019,2020\nAlpha,ALP,1.5,2.5,\nBeta,BET,n/a,3,4\n')


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "gdp.csv").write_text(WIDE)
    (tmp_path / "target.csv").write_text(WIDE.replace("1.5", "9"))
    (tmp_path / "notes.txt").write_text("free text")
    (tmp_path / "noyears.csv").write_text("a\nb\nc\nd\nCountry Name,Value\nAlpha,1\nBeta,2\n")
    (tmp_path / "long.csv").write_text("x\nx\nx\nx\ncountry,Year,value\nAlpha,2018,5\nBeta,2019,6\n")
    return tmp_path


def test_read_csv_skip_and_load_wide(spark, folder):
    df = files.read_csv_skip(spark, str(folder / "gdp.csv"), 4)
    assert df.columns == ["Country Name", "Country Code", "2018", "2019", "2020"] and df.count() == 2
    long = files.load_indicator(spark, str(folder / "gdp.csv"), "gdp")
    rows = {(r.entity, r.time): r.gdp for r in long.collect()}
    assert rows[("Alpha", 2018)] == 1.5 and rows[("Beta", 2018)] is None and rows[("Alpha", 2020)] is None
    assert set(long.columns) == {"entity", "Country Code", "time", "gdp"}



def test_read_csv_skip_per_file_and_split(spark, tmp_path):
    """Every part file of a directory has its own metadata lines and header,
    and a file cut into many scan splits keeps all of its records."""
    d = tmp_path / "parts"
    d.mkdir()
    rows = {}
    for f in range(3):
        body = "".join(f"E{f}_{i},C{i},{f * 1000 + i},{i / 4}\n" for i in range(40))
        (d / f"part-{f}.csv").write_text("meta one\n\nmeta three\n\nCountry Name,Country Code,2019,2020\n" + body)
        rows.update({f"E{f}_{i}": (str(f * 1000 + i), str(i / 4)) for i in range(40)})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
        df = files.read_csv_skip(spark, str(d), 4)
        assert df.rdd.getNumPartitions() > 3
        got = {r["Country Name"]: (r["2019"], r["2020"]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert df.columns == ["Country Name", "Country Code", "2019", "2020"]
    assert got == rows


def test_load_long_and_failures(spark, folder):
    long = files.load_indicator(spark, str(folder / "long.csv"), "value")
    assert sorted((r.entity, r.time, r.value) for r in long.collect()) == [("Alpha", 2018, 5.0), ("Beta", 2019, 6.0)]
    with pytest.raises(ValueError):
        files.load_indicator(spark, str(folder / "notes.txt"), "x")
    with pytest.raises(ValueError):
        files.load_indicator(spark, str(folder / "noyears.csv"), "x")


def test_manifest_merge_and_precedence(spark, folder):
    (folder / "gdp.parquet").mkdir()
    spark.createDataFrame([("Alpha", 2018, 7.0)], "entity string, time int, gdp double") \
         .write.mode("overwrite").parquet(str(folder / "gdp2.parquet"))
    assert files.resolve_source(spark, str(folder / "gdp2")).endswith(".parquet")
    assert files.resolve_source(spark, str(folder / "missing")) is None
    specs = [files.IndicatorSpec("target", "target"), files.IndicatorSpec("missing", "m"),
             files.IndicatorSpec("gdp2", "gdp")]
    tables = files.load_manifest(spark, str(folder), specs)
    merged = clean.outer_merge(tables, ["entity", "time"], code_col="Country Code")
    assert merged.where("entity = 'Alpha' AND time = 2018").first().gdp == 7.0
    with pytest.raises(FileNotFoundError):
        files.load_manifest(spark, str(folder), [files.IndicatorSpec("missing", "m")])


def test_processed_roundtrip_and_inventory(spark, tmp_path):
    df = spark.createDataFrame([("A", 1, "train", 1.0), ("A", 2, "test", 2.0)], "entity string, time int, split string, v double")
    sinks.write_processed(df, str(tmp_path / "proc"), sort_cols=["entity", "time"])
    back = files.read_processed(spark, str(tmp_path / "proc"), "train")
    assert [(r.entity, r.time) for r in back.collect()] == [("A", 1)]
    sinks.write_processed(df, str(tmp_path / "all" / "gdp.parquet"), sort_cols=["entity", "time"])
    (tmp_path / "all" / "gdp.csv").write_text("x" * 10)
    (tmp_path / "all" / "rate.csv").write_text("y" * 7)
    inv = {r.base: r for r in files.source_inventory(spark, str(tmp_path / "all"), ["gdp", "rate", "absent"]).collect()}
    assert inv["absent"].found is False and inv["absent"].bytes is None
    assert (inv["gdp"].found, inv["gdp"].format) == (True, "parquet") and inv["gdp"].bytes > 10
    assert (inv["rate"].format, inv["rate"].bytes) == ("csv", 7)
    with pytest.raises(ValueError):
        files.validated_panel(df, ["entity", "nope"])
    with pytest.raises(ValueError):
        files.validated_panel(df.limit(0), ["entity"])


def test_long_index_source(spark):
    df = spark.createDataFrame([("HDI", "A", "2000", "0.5"), ("X", "A", "2000", "1")],
                               "indexCode string, country string, year string, value string")
    out = files.long_index_source(df, "indexCode", "HDI", "country", "year", "value", "hdi").collect()
    assert [(r.entity, r.time, r.hdi) for r in out] == [("A", 2000, 0.5)]


def test_result_and_panel_summary_sinks(spark, tmp_path):
    import numpy as np
    import pandas as pd
    from panelspark.operators import econ
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame([(e, t, rng.normal(), rng.normal()) for e in range(5) for t in range(6)],
                       columns=["e", "t", "y", "x"])
    fe = econ.fit_twoway_fe(spark.createDataFrame(pdf), "e", "t", "y", ["x"])
    sinks.write_panel_summary(spark, fe, str(tmp_path / "panel"))
    coefs = spark.read.csv(str(tmp_path / "panel/coefficients"), header=True)
    summ = spark.read.csv(str(tmp_path / "panel/summary"), header=True).first()
    assert coefs.count() == 1 and coefs.first().term == "x"
    assert int(summ.nobs) == 30 and summ.model == "Dynamic Panel (FE)"


def test_indicator_csv_sink_roundtrip(spark, tmp_path):
    """Each part file written by the sink opens with the metadata lines and the
    header, and the A2 loader reads all of them back exactly."""
    rows = [(f"E{i}", f"C{i}", i * 0.1, None if i % 3 == 0 else i / 7.0) for i in range(30)]
    wide = spark.createDataFrame(rows, "`Country Name` string, `Country Code` string, `2019` double, `2020` double")
    path = str(tmp_path / "ind.csv")
    sinks.write_indicator_csv(wide.repartition(3), path, ["meta,1", "", "meta,3", ""])
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) >= 2
    for f in parts:
        with open(os.path.join(path, f)) as fh:
            head = [fh.readline().rstrip("\n") for _ in range(5)]
        assert head == ["meta,1", "", "meta,3", "", "Country Name,Country Code,2019,2020"]
    long = files.load_indicator(spark, path, "v")
    got = {(r.entity, r.time): r.v for r in long.collect()}
    exp = {}
    for name, _, a, b in rows:
        exp[(name, 2019)] = a
        exp[(name, 2020)] = b
    assert got == exp


def test_part_files_with_other_headers_are_refused(spark, tmp_path):
    d = tmp_path / "x.csv"
    d.mkdir()
    (d / "a.csv").write_text("m\nCountry Name,2018,2019\nA,1,2\n")
    (d / "b.csv").write_text("m\nCountry Name,2019,2018\nB,3,4\n")
    with pytest.raises(ValueError):
        files.read_csv_skip(spark, str(d), 1)


def test_missing_value_column_is_refused(spark, tmp_path):
    spark.createDataFrame([("A", 2000, "yes")], "Country string, Year int, flag string").write.json(str(tmp_path / "gdp.json"))
    with pytest.raises(ValueError):
        files.load_indicator(spark, str(tmp_path / "gdp.json"), "gdp")


def test_entity_spelling_with_lower_case_name(spark):
    from panelspark.operators import clean
    df = spark.createDataFrame([("Europe", "A", "1")], "Region string, `Country name` string, `2018` string")
    assert clean.standardize_entity(df).columns == ["Region", "entity", "2018"]


@pytest.mark.parametrize("split", [1 << 20, 64])
def test_quoted_line_breaks(spark, tmp_path, split):
    """Records over several lines, blank lines inside a quoted field and escaped quotes, in one split and in many."""
    import csv
    import io
    import pandas as pd
    d = tmp_path / "parts"
    d.mkdir()
    want = set()
    for f in range(3):
        rows = [(f"E{f}_{i}" + ("\nsecond line" if i % 3 == 0 else "\n\nthird, line" if i % 7 == 0 else ""), f"C{i}", str(i), str(i / 4))
                for i in range(25)] if f else [(f"P{i}", f"C{i}", str(i), "1") for i in range(25)]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(rows)
        text = "meta \"one\n\nmeta\n\nName,Code,2019,2020\n" + out.getvalue()
        (d / f"part-{f}.csv").write_text(text)
        ref = pd.read_csv(io.StringIO(text), skiprows=4, quoting=csv.QUOTE_MINIMAL) if f == 0 else pd.read_csv(
            io.StringIO(text.split("\n", 4)[4]))
        assert len(ref) == 25
        want |= set(rows)
    (d / "part-9.csv").write_text('m\n\nm\n\nName,Code,2019,2020\nTube 5" wide,X,1,2\n')        # no pair: stays a line
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        got = [tuple(r) for r in files.read_csv_skip(spark, str(d), 4).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 76 and want <= set(got)
    assert ('Tube 5" wide', "X", "1", "2") in got
