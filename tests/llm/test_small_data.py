"""Every operator on sf0.001 against SQL, brute force or held-out truth."""

import html
import re

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF
from tests.llm import brute

TABLES = "documents embeddings pages benchmark labels".split()


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name):
    return E.queries()[name](spark, SF).collect()


@pytest.mark.parametrize("name", ["op4_source_mix", "op8_top_k", "op10_url_filter"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    assert [repr(x) for x in got] == [repr(x) for x in sorted(res.fetchall())]


def test_op1_brute(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in rows(spark, "op1_decontaminate")}
    assert got == brute.leaks(docs, items)


def test_op2_brute(spark, docs):
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows(spark, "op2_repeated_words"))
    assert got == brute.repeated_words(docs)


def test_op3_truth(spark):
    src = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows(spark, "op3_html_text"):
        page = src[r.page_id]
        inner = page[page.index("<article>") + 9:page.index("</article>")]
        want = " ".join(html.unescape(re.sub(r"</?(p|h1|br)>", " ", re.sub(r"</?b>", "", inner))).split())
        assert r.text == want and r.n_chars == len(want)


def test_op5_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows(spark, "op5_language_id") if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_op6_brute(spark, docs):
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(spark, "op6_repeated_bytes"))
    assert got == brute.repeated_bytes(docs)


def test_op7_base_and_score(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op7_lm_score")}
    for d, held, n, known, total, base in brute.base_scores(docs):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    # far better than bytes at random
    assert sum(r.score for r in got.values()) > -0.5 * sum(len(t.encode()) * 2.408 for _, t in docs)


def test_op9_brute(spark, docs):
    want = brute.near_dups(docs)
    for r in rows(spark, "op9_near_dup"):
        assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id)
        assert r.n_shingles == len(brute.shingles(dict(docs)[r.doc_id]))


def test_pipeline_stages(spark, docs):
    import corpus_pipeline as P
    d = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in P.STAGES:
        before = {r.doc_id: r for r in d.collect()}
        out = stage(spark, d, SF)
        if name == "source_mixing":
            assert {r.doc_id for r in out.collect()} == set(before)
            break
        assert out.columns == d.columns
        after = {r.doc_id: r for r in out.collect()}
        pairs = [(r.doc_id, r.text) for r in before.values()]
        if name == "language_id":
            assert set(after) == {k for k, r in before.items() if r.text and any(c.isalpha() for c in r.text)}
        elif name == "near_dedup":
            top = brute.near_dups(pairs)
            assert set(after) == {k for k in before if top[k] == k}
        elif name == "substring_dedup":
            want = {w[0]: w for w in brute.repeated_words(pairs)}
            assert set(after) == set(before)
            for k, r in after.items():
                assert r.n_chars == len(r.text)
                assert len(brute.words(r.text)) == want[k][1] - want[k][2]
                if want[k][2] == 0:
                    assert r.text == before[k].text
        else:
            assert set(after) == set(before) - {k for k, _ in brute.leaks(pairs, items)}
        d = out
