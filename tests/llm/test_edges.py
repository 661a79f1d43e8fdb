"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing
extra columns, for every operator and pipeline stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from panelspark.llm import (debruijn, decontaminate, html_text, language_id, lm_score, mixing, near_dup, suffix_dedup,
                            url_filter, vector_search)
from panelspark.llm.common import prepare
from tests.llm import brute

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# columns whose names the operators use inside
EXTRA = ["id", "th", "key", "size", "a", "b", "h", "m", "spans", "has_letter", "k_text", "start", "held_out", "score"]

PASSAGE = " ".join(f"passage{i}" for i in range(30))
LONG = " ".join(f"w{i % 977}x{i % 1013}" for i in range(60000)) + " " + PASSAGE
EN = "the cat and the dog went to the old house on the hill and sat by the fire all day"
DE = "der hund und die katze gingen zu dem alten haus auf dem berg und lagen am feuer"
ROWS = [
    (1, "start one " + PASSAGE + " end one", "en", "s", 3), (2, "begin two " + PASSAGE + " stop two", "en", "s", 3),
    (2, "begin two " + PASSAGE + " stop two", "en", "s", 3), (3, None, "en", "s", 0), (4, "", "de", None, 0),
    (5, "   \n\t ", None, "s", 0), (6, "12345 !!! 67890", "en", "t", 9), (7, "tiny", "en", "t", 4),
    (8, LONG, "en", None, 9), (9, LONG + " tail", None, "u", 9), (10, "la " * 400, "fr", "u", 1200),
    (11, "=" * 3000, "en", "u", 3000), (12, "tie tie tie tie tie", "en", "v", 9), (13, "tie tie tie tie tie", "de", "v", 9),
    (14, EN, "en", "v", 9), (15, DE, "de", "v", 9), (16, EN + " " + EN, "en", "w", 9), (17, "é ü ñ", "es", "w", 5),
    (None, EN, "en", "w", 9), (18, "A" * 50, "en", "", 50), (20, DE + " " + DE, "de", "", 9),
]


def clash(df):
    for c in EXTRA:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return clash(spark.createDataFrame(ROWS, DOC)).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    prepare(spark)
    return clash(spark.createDataFrame([], DOC))


PAIRS = [(-1 if r[0] is None else r[0], r[1]) for r in ROWS]


def test_op2(docs, empty):
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept)
                 for r in debruijn.dedup_words(docs, ["doc_id"]).collect())
    assert got == brute.repeated_words(PAIRS)
    assert debruijn.dedup_words(empty, ["doc_id"]).count() == 0


def test_op6(docs, empty):
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in suffix_dedup.dedup_bytes(docs, ["doc_id"]).collect())
    assert got == brute.repeated_bytes(PAIRS)
    assert suffix_dedup.dedup_bytes(empty, ["doc_id"]).count() == 0


@pytest.mark.parametrize("hot", [0, 1])
def test_op6_hot_anchors(spark, monkeypatch, hot):
    """A line in many surroundings, settled in blocks or window by window."""
    monkeypatch.setattr(suffix_dedup, "HOT", 1 if hot else 1024)
    line = "this very common line is longer than a hundred bytes, so that windows lie in it, and it ends right here: now"
    rows = [(i, f"{i} {'abcdef'[i % 6] * (i % 9)}{line}{'xyz'[i % 3] * (i % 7)}{i * 7}") for i in range(120)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r) for r in suffix_dedup.dedup_bytes(d, ["doc_id"]).collect())
    assert got == brute.repeated_bytes(rows)


def test_op9(docs, empty):
    want = brute.near_dups([p for p in PAIRS if p[0] >= 0])
    for r in near_dup.near_dup_classes(docs).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert near_dup.near_dup_classes(empty).count() == 0


def test_op9_near_copies_in_one_bucket(spark):
    """A chain of edits: neighbours are similar, ends are not; one component."""
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(60):
        base[(i * 2) % 120] = f"edit{i}"
        rows.append((i, " ".join(base)))
    rows += [(100 + i, " ".join(f"p{j}" if j > 40 else f"own{i}-{j}" for j in range(100))) for i in range(40)]
    want = brute.near_dups(rows)
    got = near_dup.near_dup_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_op1(spark, docs, empty):
    items = [(1, PASSAGE), (2, None), (3, ""), (4, "sat by the"), (5, "la " * 30), (6, PASSAGE.upper()), (7, EN + " " + EN), (8, "tiny")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("gram", F.lit(1)).withColumn("row", F.lit(2))
    got = {(-1 if r.doc_id is None else r.doc_id, r.item_id): (r.similarity, r.start_word)
           for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == brute.leaks(PAIRS, items)
    kept = sorted(-1 if r.doc_id is None else r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect())
    bad = {d for d, _ in got}
    assert kept == sorted(d for d, _ in PAIRS if d not in bad)
    assert decontaminate.find_leaks(empty, bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_leaks(docs, bench.limit(0)).count() == len(ROWS)


def test_op1_blocks_of_the_benchmark(spark, docs, monkeypatch):
    items = [(i, " ".join(f"passage{j}" for j in range(i, i + 15))) for i in range(15)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 4)
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == brute.leaks([p for p in PAIRS if p[0] >= 0], items)


def test_op3(spark):
    page = "<nav>a b</nav><article><h1>T</h1><p>" + "w " * 50000 + "</p></article><footer>x</footer>"
    rows = [(1, "u", None), (2, "u", ""), (3, None, page), (3, None, page), (None, "u", "<article><p>&lt;ok&gt;  a\n b"), (4, "u", "<script>x")]
    d = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("blocks", F.lit(1)).withColumn("text", F.lit("t"))
    got = sorted(((r.page_id or 0), r.text, r.n_chars) for r in html_text.main_text(d).collect())
    long = "T " + " ".join(["w"] * 50000)
    assert got == sorted([(1, "", 0), (2, "", 0), (3, long, len(long)), (3, long, len(long)), (0, "<ok> a b", 8), (4, "", 0)])
    assert html_text.main_text(d.limit(0)).count() == 0


def test_op4(docs, empty):
    rows = mixing.taken_words(docs).collect()
    assert len(rows) == len(ROWS)
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        by.setdefault(r.source, []).append(r)
    assert abs(sum(v[0].target for v in by.values()) - total) < 1e-6
    for v in by.values():
        assert v[0].target <= 3 * v[0].source_size + 1e-9
        assert abs(sum(r.taken for r in v) - v[0].target) <= 1
        assert v[0].source_size == sum(r["size"] for r in v)
    again = mixing.taken_words(docs.repartition(3)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert mixing.taken_words(empty).count() == 0


def test_op4_every_prefix_is_mixed(spark):
    rows = [(i, "w " * 40, f"s{i % 4}") for i in range(800)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    lines, segments = mixing.mix_sources(d, block_words=64)
    got = segments.groupBy("slot", "key").agg(F.sum("words").alias("w")).orderBy("slot").collect()
    half = max(r.slot for r in got) // 2
    whole = {k: sum(r.w for r in got if r["key"] == k) for k in {r["key"] for r in got}}
    for k, w in whole.items():
        part = sum(r.w for r in got if r["key"] == k and r.slot <= half)
        assert abs(part / w - 0.5) < 0.05


def test_op4_blocks_grow_with_the_mix(spark, monkeypatch):
    d = spark.createDataFrame([(i, "w " * 40, f"s{i % 4}") for i in range(400)], "doc_id bigint, text string, source string")
    monkeypatch.setattr(mixing, "MAX_SLOTS", 64)
    lines, segments = mixing.mix_sources(d, block_words=1)
    assert segments.agg(F.max("slot")).first()[0] < 2 * (64 + 4)
    targets = {r["key"]: r.target for r in lines.select("key", "target").distinct().collect()}
    for r in segments.groupBy("key").agg(F.sum("words").alias("w")).collect():
        assert abs(r.w - targets[r["key"]]) <= 1


def test_op4_salted_sources(docs, monkeypatch):
    whole = sorted(map(repr, mixing.taken_words(docs).collect()))
    monkeypatch.setattr(mixing, "MAX_SOURCES", 0)
    assert sorted(map(repr, mixing.taken_words(docs).collect())) == whole


def test_op5(docs, empty):
    rows = language_id.identify(docs).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        text = [t for d, t in PAIRS if d == (-1 if r.doc_id is None else r.doc_id)][0]
        if not text or not any(c.isalpha() for c in text):
            assert r.lang_pred == "und" and r.score == 0
        else:
            assert r.lang_pred in ("en", "de", "fr", "es") and 0 < r.score <= 1
    assert language_id.identify(empty).count() == 0
    blind = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in blind} == {"und"}


def test_op7(docs, empty):
    got = sorted(((-1 if r.doc_id is None else r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                 for r in lm_score.score_texts(docs).collect())
    want = sorted((-1 if d is None else d, h, n, k, t, round(b, 4)) for d, h, n, k, t, b in brute.base_scores([r[:2] for r in ROWS]))
    assert got == want
    assert lm_score.score_texts(empty).count() == 0


def test_op8(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.25]), (20, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (2, [0.5, 0.25]), (3, None), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [None, 1.0]), (40, []), (7, [1.0]), (8, [-0.001, 2.0, 9.0]), (20, [0.25, 0.5]), (None, [1.0, 1.0])]
    rows += [(100 + i, [i / 7.0, -i / 3.0]) for i in range(30)]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("v", F.lit(1)).withColumn("shard", F.lit(1))
    v = vector_search.scaled(d)
    got = sorted(tuple(r) for r in vector_search.top_k(v.filter("vec_id % 20 = 0"), v).collect())
    import numpy as np
    exact = [(i, x if x is None else [None if y is None else float(np.float32(y)) for y in x]) for i, x in rows]
    assert got == brute.top_k(exact)
    none = v.limit(0)
    assert vector_search.top_k(none, none).count() == 0
    few = v.filter("vec_id < 3")
    assert vector_search.top_k(few.filter("vec_id % 20 = 0"), few).count() == 3


def test_op10(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/x?q"), (4, "http://A.Example.NET/en/x?q"),
            (5, "https://example.com"), (6, "x://b.example.com/de/#f"), (7, "http://a.org/fr/"), (8, "http://notexample.net/en/"),
            (9, "http://net"), (10, "ftp://h.co.uk:80/p"), (None, "http://z.info/" + "p" * 50000), (11, "a://b://c/d")]
    d = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit("h")).withColumn("n", F.lit(1))
    bad = spark.createDataFrame([(10, 1)] * 60 + [(5, 0)] * 5 + [(11, 0)] * 200 + [(None, 1)], "page_id bigint, bad int")
    got = {(r.page_id, r.host): (r.path[:9], r.rule, r.verdict) for r in url_filter.judge_urls(d, bad).collect()}
    assert got[1, ""] == ("", None, "allow") and got[3, ""] == ("", None, "allow")
    assert got[4, "a.example.net"] == ("/en/x", "example.net/en/", "allow")
    assert got[5, "example.com"][:2] == ("", None)
    assert got[6, "b.example.com"] == ("/de/", "example.com/de/", "block")
    assert got[7, "a.org"] == ("/fr/", "org/fr/", "allow")
    assert got[8, "notexample.net"] == ("/en/", "net/", "block")
    assert got[9, "net"][:2] == ("", None)
    assert got[10, "h.co.uk:80"][2] == "block"
    assert got[11, "b:"][0] == "//c/d"
    assert url_filter.judge_urls(d.limit(0), bad).count() == 0
    assert url_filter.judge_urls(d, bad.limit(0)).count() == len(rows)
    few = url_filter.host_reputation(d.select("page_id", F.lit("h.co.uk").alias("host")), bad).first()
    assert few.lower < few["mean"]


@pytest.mark.parametrize("step", range(len(P.STAGES)))
def test_stages(spark, docs, empty, step, tmp_path):
    name, stage = P.STAGES[step]
    folder = str(tmp_path)
    spark.createDataFrame([(1, "nothing of this kind is in any of the texts")], "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    out = stage(spark, docs, folder)
    if step < len(P.STAGES) - 1:
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    groups = brute.near_dups([p for p in PAIRS if p[0] >= 0])
    want = {"language_id": sum(any(c.isalpha() for c in t or "") for _, t in PAIRS),
            "near_dedup": 1 + len(set(groups.values()))}              # and the row without an id
    assert out.count() == want.get(name, len(ROWS))
    assert stage(spark, empty, folder).count() == 0
