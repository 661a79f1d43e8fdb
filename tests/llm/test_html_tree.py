"""The HTML tree decides by link density and neighbours where markup says nothing."""

import pytest
from pyspark.ml.linalg import Vectors

from panelspark.llm import html_text as H

L = "word " * 40
# lengths that no labelled page has
HELD_OUT = ((4, 18, 70, 6, 2), (33, 5, 12, 80), (2, 150, 9), (60,), (11, 3, 3, 26, 1))
PROBES = [                      # page, texts kept (L as "L")
    ("<body><div><a>Home</a> <a>World news</a> <a>Sport</a></div><div><h1>Dam opens</h1><p>" + L + "</p><p>All went well.</p><p>" + L
     + "</p></div><div><a>Terms</a></div></body>", ["Dam opens", "L", "All went well.", "L"]),
    ("<ul><li><a>Home</a></li><li><a>World news</a></li></ul><h1>Dam opens</h1><p>" + L + "see <a>the dam</a></p><ul><li><a>Imprint</a></li></ul>",
     ["Dam opens", L + "see the dam"]),
    ("<article><h1>T</h1><p>" + L + "</p><p class='share-price'>Up two.</p><div class='social-text'>On us</div><blockquote class='notice'>So it is"
     "</blockquote><p>one <a>link here</a></p><ul><li><a>Read next</a></li><li><a>Sign up now</a></li></ul></article>",
     ["T", "L", "Up two.", "On us", "So it is", "one link here"]),
    ("<header>Site</header><h1>The dam</h1><article><p>" + L + "</p><p>Short.</p></article><footer>f</footer>", ["The dam", "L", "Short."]),
    ("<div>Welcome</div><div>Back to top</div><article><p>" + L + "</p></article><div>Back to top</div><h3>More</h3><p>Thanks</p>", ["L"]),
    ("<article><p>a</p><div class='cookie-notice-box'>We set cookies</div><div id='ads-2'>Buy</div><p class='ad'>Buy</p><section id='comment-list'>"
     "<p>Me too</p></section><div class='newsletter signup-form'>Mail</div><p>b</p></article>", ["a", "b"]),
    ("<article><p>Tiny</p></article>", ["Tiny"]), ("<p>" + L + "</p><p>Short.</p>", ["L", "Short."]),
]


@pytest.fixture(scope="module")
def tree(spark):
    return H.train_tree(spark)


def kept(tree, page):
    return [(t, bool(tree.predict(Vectors.dense(x)))) for t, x in H.blocks_of(page)]


@pytest.mark.parametrize("page, want", PROBES)
def test_probe_pages(tree, page, want):
    assert [t for t, k in kept(tree, page) if k] == [(L if w == "L" else w).strip() for w in want]


def test_held_out_pages(tree):
    said = [(lab, "".join(str(int(k)) for _, k in kept(tree, page))) for _, lab, page in H.patterned_pages(HELD_OUT)]
    blocks = sum(len(lab) for lab, _ in said)
    assert sum(a != b for lab, got in said for a, b in zip(lab, got)) <= 0.02 * blocks
    # pages without an article element, where only words, links and neighbours can tell
    bare = [(lab, "".join(str(int(k)) for _, k in kept(tree, page))) for n, lab, page in H.patterned_pages(HELD_OUT) if "bare" in n]
    assert len(bare) == len(HELD_OUT)
    assert sum(a != b for lab, got in bare for a, b in zip(lab, got)) <= 0.03 * sum(len(lab) for lab, _ in bare)



def test_density_and_neighbours_decide(tree):
    weight = dict(zip(H.FEATURES, tree.featureImportances.toArray()))
    assert weight["links"] > 0.05 and weight["near_words"] > 0.02 and weight["headline"] > 0
