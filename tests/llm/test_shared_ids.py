"""Ids with several texts, and strings around very common lines."""

import random

import pytest

from panelspark.llm import near_dup, suffix_dedup
from panelspark.llm.common import prepare
from tests.llm import brute

DOC = "doc_id bigint, text string"


def text(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))


def near(t):
    return t + " one more word"


A, B = text(1), text(2)
ROWS = [(5, A), (5, B), (3, near(A)), (1, near(B)), (20, text(3)), (20, None), (20, text(4)), (8, text(4)), (30, ""), (30, text(5)),
        (31, near(text(5))), (40, "a b"), (40, "c d"), (7, "c d"), (None, A), (9, text(6)), (9, text(6))]


@pytest.mark.parametrize("extra", [0, 40])
def test_an_id_is_linked_through_any_of_its_texts(spark, extra):
    prepare(spark)
    rows = ROWS + [(100 + i, near(A if i % 2 else B) + f" v{i}") for i in range(extra)]
    got = near_dup.near_dup_classes(spark.createDataFrame(rows, DOC).repartition(4)).collect()
    want = brute.near_dups([(d, t) for d, t in rows if d is not None])
    per = {}
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.kept == (r.doc_id == r.component_id)
            per.setdefault(r.doc_id, set()).add(r.component_id)
    assert per == {d: {c} for d, c in want.items()}
    assert per[5] == per[3] == {1} and per[20] == {8} and per[40] == {7}


@pytest.mark.parametrize("hot", [1, 3, 8])
def test_op6_common_line_in_many_surroundings(spark, hot, monkeypatch):
    """A line of 60, 100 or 130 bytes in many different surroundings, some of which agree for a part: keys stay crowded on every level."""
    prepare(spark)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(hot)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))                  # noqa: E731
    rows = []
    for n in (60, 100, 130):
        line, heads, tails = word(n), [word(80) for _ in range(6)], [word(80) for _ in range(6)]
        for _ in range(25):
            h, t = rng.choice(heads), rng.choice(tails)
            rows.append((len(rows) + 1, word(rng.randrange(90)) + h[rng.randrange(80):] + line + t[:rng.randrange(80)] + word(rng.randrange(90))))
    rows += [(3, rows[10][1]), (rows[20][0], rows[20][1])]
    got = sorted(tuple(r) for r in suffix_dedup.dedup_bytes(spark.createDataFrame(rows, DOC).repartition(3), ["doc_id"]).collect())
    assert got == brute.repeated_bytes(rows)
