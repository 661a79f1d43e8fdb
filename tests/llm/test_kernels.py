"""Small kernels against their definitions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from panelspark.llm import html_text, lm_score, near_dup, vector_search
from panelspark.llm.common import text_chunks, word_hashes, word_spans
from panelspark.llm.suffix_dedup import suffix_order
from panelspark.llm.supers import sliding_min, super_windows


def test_suffix_order_small_alphabets():
    rng = random.Random(5)
    for _ in range(1500):
        s = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_order(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_sliding_min():
    x = np.array(random.Random(1).sample(range(1000), 200))
    for w in (1, 2, 3, 7, 64, 200):
        assert sliding_min(x, w).tolist() == [x[i:i + w].min() for i in range(len(x) - w + 1)]


def test_super_windows_cover_every_window_once():
    rng = np.random.default_rng(2)
    lens = [0, 5, 30, 0, 100, 19, 20, 0]
    values = rng.integers(0, 3, sum(lens)).astype(np.uint64)        # periodic and constant stretches
    values[40:80] = 7
    starts = np.concatenate([[0], np.cumsum(lens)])
    seq, lo, hi, m, h = super_windows(values, starts, 20, 8)
    seen = sorted((int(s), x) for s, a, b in zip(seq, lo, hi) for x in range(a, b + 1))
    assert seen == [(s, x) for s, n in enumerate(lens) for x in range(max(0, n - 19))]
    assert (hi - lo <= 12).all()
    content = {}
    for s, a, b, am, ah in zip(seq, lo, hi, m, h):
        text = values[starts[s] + a:starts[s] + b + 20].tobytes()
        assert content.setdefault((am, ah), text) == text


def test_words_split_like_ascii_space():
    texts = ["", " a\tb\x0bc ", "x", None, "é\x1cz q r", "\n\n", "last"]
    got = []
    for _, starts, buf in text_chunks(pa.array(texts), 7):
        a, b, first = word_spans(buf, starts)
        raw = buf.tobytes()
        for j in range(len(starts) - 1):
            got.append([raw[a[i]:b[i]] for i in range(first[j], first[j + 1])])
    assert got == [(t or "").encode().split() for t in texts]


def test_word_hashes_depend_on_the_word_only():
    buf = np.frombuffer(b"ab a ab b aba a", np.uint8)
    a, b, _ = word_spans(buf, np.array([0, len(buf)]))
    h = word_hashes(buf, a, b).tolist()
    assert h[0] == h[2] and h[1] == h[5] and len(set(h)) == 4


def test_sketch_fills_every_coordinate_and_estimates():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2 ** 63, 2000).astype(np.uint64)
    a, b = np.unique(x[:1500]), np.unique(x[500:])
    sk = near_dup.sketches([a, b, a[:1], a[:3]])
    assert (sk != np.uint64(2 ** 64 - 1)).all()
    assert abs((sk[0] == sk[1]).mean() - 0.5) < 0.15


def test_common_counts():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 50, n).astype(np.uint64)) for n in (1, 10, 30, 40, 60)]
    want = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    got = near_dup.common_counts(sets)
    off = ~np.eye(len(sets), dtype=bool)
    assert (got[off] == np.array(want)[off]).all()


def test_tree_tables_give_a_distribution_per_byte():
    from panelspark.llm.language_id import Tree, _count_grams
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y"]), pa.array(["abcabcabdabc" * 20, "zyzyxzyz" * 30])], ["lang", "text"])
    counts = []
    for b in _count_grams([batch]):
        counts += list(zip(*[b.column(c).to_pylist() for c in ("lang", "k", "gram", "n")]))
    tree = Tree(sorted(counts))
    width = tree.width
    per = np.exp2(-tree.cost.reshape(-1, width, 2).astype(float))[:, :-1].sum(1)      # without the class of other bytes
    assert (per <= 1 + 1e-6).all()
    buf = np.frombuffer(b"abcabc" + b"zyzy", np.uint8)
    bits = tree.code_lengths(buf, np.array([0, 6, 6, 10]))
    assert bits[0].argmin() == 0 and bits[2].argmin() == 1 and (bits[1] == 0).all()


def test_word_model_is_a_distribution():
    model = lm_score.Mixer([np.zeros(2 << b, np.float32) for b in lm_score.TABLE_BITS]).freeze()
    words = pa.array([b"", b"a", b"ab" * 50], pa.binary())
    assert model.log10_prob(words) == pytest.approx([-8 * 0.30103 * n for n in (1, 2, 101)], rel=1e-3)


def test_blocks_of_odd_pages():
    f = lambda p: [t for t, _ in html_text.blocks_of(p)]                              # noqa: E731
    assert f("a &amp; b&nbsp;c<p>d\n\n e<script>var x='<p>no</p>'") == ["a & b c", "d e"]
    assert f("x<!-- <p>no --> y<b>z</b>w<br>v") == ["x yzw v"]
    assert f("<div title='a>b'>in</div>< 3 <a <p>q") == ["in", "< 3 <a", "q"]
    assert f("") == [] and f("<html><head><title>t</title></head></html>") == []


def test_marked_blocks_are_furniture():
    page = """<body class="has-sidebar"><article class="post legal"><h1>T</h1><p>one</p><p class="ad">buy</p><p>two</p>
      <div id="comments"><article class="comment"><p>me too</p></article></div></article>
      <article class="related teaser"><p>more</p></article><section role="complementary"><p>side</p></section></body>"""
    marks = [(t, x[6], x[7]) for t, x in html_text.blocks_of(page)]
    assert [t for t, furniture, article in marks if article and not furniture] == ["T", "one", "two"]
    assert [t for t, furniture, _ in marks if furniture] == ["buy", "me too", "more", "side"]


def test_search_block_big_numbers_and_ties():
    q = np.array([[3], [2 ** 40]])
    rows = np.array([[1, 1, 5], [2 ** 20, 2 ** 20, -1]])
    qi, ids, s = vector_search.search_block(np.array([7]), q, [(np.array([9, 8, 7]), rows)], 2)
    assert ids.tolist() == [8, 9] and s.tolist() == [3 + 2 ** 60] * 2
