"""The operators do the whole job where they once did less."""

import collections
import zlib

import numpy as np

from panelspark.llm import decontaminate, html_text, lm_score
from panelspark.llm.common import prepare, word_hashes, word_spans
from tests.llm import brute


def test_op7_counts_of_all_contexts(spark, monkeypatch):
    """Exact counts in every context, above 2**24 too, over several chunks and buckets; every training word is learned on."""
    prepare(spark)
    monkeypatch.setattr(lm_score, "BUCKET_KEYS", 1 << 8)
    rng = np.random.default_rng(1)
    words = {bytes(rng.integers(97, 101, rng.integers(1, 7)).tolist()): int(rng.integers(0, 5)) for _ in range(600)}
    words |= {b"": 7, b"ab": 1 << 24}
    vocab = spark.createDataFrame([(bytearray(w), c, c + 1) for w, c in words.items()],
                                  "word binary, c_train bigint, c_all bigint").repartition(3)
    chunks = lm_score.context_counts(vocab, 4000)

    def pairs(w):
        full = w + bytes([lm_score.END])
        for i, c in enumerate(full):
            for k, width in enumerate(lm_score.CONTEXT_BYTES):
                yield k, i, (k, full[max(0, i - width) if width else 0:i], min(i, width or 255)), c

    want = collections.Counter()
    for w, n in words.items():
        for k, _, x, c in pairs(w):
            for j in range(9):
                want[x, j, c >> (8 - j)] += n if lm_score.CONTEXT_BYTES[k] or n >= lm_score.PREFIX_MIN else 0
    seen = set()
    for some, train, _, starts, (own, other, at) in lm_score._with_counts(chunks.toArrow().to_batches()):
        for q, w in enumerate(some.to_pylist()):
            seen.add(w)
            assert words[w] == train[q]
            for k, i, x, c in pairs(w):
                place = at[k][starts[q] + i]
                for j in range(8):
                    mine = want[x, j + 1, c >> (7 - j)]
                    assert (own[j + 1][place], other[j][place]) == (mine, want[x, j, c >> (8 - j)] - mine)
    assert seen == set(words)
    # every coded bit of every training occurrence was learned on
    total = sum(n * (len(w) + 1) * 8 for w, n in words.items())
    learned = [np.frombuffer(b.column("seen")[0].as_buffer()).sum() for b in lm_score._learn(chunks.toArrow().to_batches())]
    assert learned == [total]


def test_op3_dropped_elements_without_end_tag():
    f = lambda p: [t for t, _ in html_text.blocks_of(p)]                              # noqa: E731
    body = "<article><p>one</p><p>two</p></article>"
    assert f("<html><head><title>t</title><body>" + body) == ["one", "two"]
    assert f("<html><head><title>t</title><meta charset=x>" + body) == ["one", "two"]
    assert f("<html><head><title>t</title>words <b>and</b> more") == ["words and more"]
    assert f("<head><title>t<body>" + body) == ["one", "two"]
    assert f("<head>junk<script>'<p>'</script>junk</head>" + body) == ["one", "two"]
    assert f("<head>junk<body>" + body + "<p>x</head>y") == ["one", "two", "x", "y"]
    for empty in ("<svg/>", "<svg a='>' b />", '<iframe src="a"/>', "<iframe src=a />", "<IFRAME src=a>", "<svg>", "<math hidden/>", "<script src='a'/>"):
        assert f(f"<article><p>one</p><p>{empty}two</p></article>") == ["one", "two"], empty
    # an unquoted value may end in a slash; elements that have their end tag go as before
    assert f("<p>one<script src=a/>two</script><svg><text>no</text></svg> three") == ["one", "three"]
    assert f("<p>one<script>two<p>three") == ["one"] == f("<p>one<style>two<p>three") == f("<p>one<!-- two<p>three")
    assert f("<p>a" + "<iframe src=x>" * 20000 + "b") == ["a", "b"]


def test_op1_items_with_a_shared_prompt():
    prompt = " ".join(f"p{i}" for i in range(196))
    items = [(k, f"{prompt} " + " ".join(f"u{k}x{i}" for i in range(5))) for k in range(200)]
    docs = [(d, items[d][1].replace(f"u{d}x0", "edit")) for d in range(10)]
    want = brute.leaks(docs, items)
    assert len(want) == 2000 and {v[0] for v in want.values()} == {0.75}       # 192 shingles of weight 10, five of 64
    rows = []
    for k, t in items:
        buf = np.frombuffer(t.encode(), np.uint8)
        a, b, _ = word_spans(buf, np.array([0, len(buf)]))
        g = decontaminate._grams(word_hashes(buf, a, b), 5)
        rows.append((k, len(a), g.astype(np.int64), [200] * 192 + [1] * 5))
    index = decontaminate.Index(rows)
    text = [t.encode() for _, t in docs]
    got = index.scan(np.frombuffer(b"".join(text), np.uint8), np.cumsum([0, *map(len, text)]))
    found = {(d, k): (v[0], -v[1]) for d, own in got.items() for k, v in own.items()}
    assert all(want[p] == v for p, v in found.items())
    assert len(found) >= 0.99 * len(want)


def test_op7_holds_a_chunk_s_paths_in_narrow_integers():
    own, other = lm_score.followed(lm_score._small(np.array([[0, 2]] * 8 + [[5, 1 << 20]])))
    assert own.dtype == other.dtype == np.int32 and own[:, 0].tolist() == [5] * 9
    assert own[0, 1] == (1 << 20) + 16 and other[7].tolist() == [0, 2]
    own, _ = lm_score.followed(lm_score._small(np.full((9, 1), 1 << 28)))
    assert own.dtype == np.int64 and own[0, 0] == 9 << 28


def test_op7_contexts_reach_over_words(spark, monkeypatch):
    """Every symbol of every text is counted and coded once, in the last 1, 2, 3 and 5 bytes before it, over closing bytes too."""
    prepare(spark)
    monkeypatch.setattr(lm_score, "BUCKET_KEYS", 1 << 6)
    monkeypatch.setattr(lm_score, "CHUNK_SYMBOLS", 200)
    rng = np.random.default_rng(3)
    some = [bytes(rng.integers(97, 100, rng.integers(1, 8)).tolist()).decode() for _ in range(60)] + ["é€x", "A"]
    texts = ["", " ", "a", None] + [" \n".join(rng.choice(some, rng.integers(1, 30))) for _ in range(30)]
    rows = [(bool(i % 4 == 0), t) for i, t in enumerate(texts)]
    rows.append(rows[-1])
    vocab = lm_score.units(spark.createDataFrame(rows, "held_out boolean, text string").repartition(3)).cache()

    split = [(h, [w.lower().encode() for w in (t or "").split()]) for h, t in rows]
    count = collections.Counter(w for h, ws in split if not h for w in ws)
    want, coded = collections.Counter(), collections.Counter()
    for held, ws in split:
        flow = b" "
        for w in ws + [b""]:
            for i, c in enumerate(w + b" "):
                for k, width in enumerate(lm_score.CONTEXT_BYTES):
                    x = (k, flow[-width:] if width else w[:i])
                    n = 1 if width or not w or count[w] >= lm_score.PREFIX_MIN else 0
                    for j in range(9 if not held else 0):
                        want[x, j, c >> (8 - j)] += n
                coded[flow[-5:] if i < 4 else w[:i], i, c] += 1
                flow += bytes([c])
    got = collections.Counter()
    rows = lm_score.context_counts(vocab, 9000).collect()
    assert {r.kind for r in rows} == {lm_score.WORDS, lm_score.HEADS} and len(rows) > 9
    for r in map(lambda r: r.asDict(), rows):
        units, left, _, both = lm_score._unpack(r)
        starts, (own, other, at) = lm_score._counted(r)
        for q, u in enumerate(units.to_pylist()):
            w = u[left[q]:]
            todo = range(min(4, len(w) + 1)) if r["kind"] == lm_score.HEADS else range(4, len(w) + 1)
            assert starts[q + 1] - starts[q] == len(todo)
            for s, i in zip(range(starts[q], starts[q + 1]), todo):
                c = (w + b" ")[i]
                assert at[-1][s] == c
                got[(u[:left[q]] + w[:i])[-5:] if i < 4 else w[:i], i, c] += both[q]
                for k, width in enumerate(lm_score.CONTEXT_BYTES):
                    x = (k, (u[:left[q]] + w[:i])[-width:] if width else w[:i])
                    for j in range(8):
                        mine = want[x, j + 1, c >> (7 - j)]
                        assert (own[j + 1][at[k][s]], other[j][at[k][s]]) == (mine, want[x, j, c >> (8 - j)] - mine)
    assert got == coded


def test_op7_order_of_words_counts(spark):
    """The same words in an order never seen score lower; white space does not matter."""
    prepare(spark)
    words = "wood rain salt fire leaf iron dust moon".split()
    rng = np.random.default_rng(7)
    ids = range(1000)
    held = [i for i in ids if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    train = [i for i in ids if zlib.crc32(str(i).encode()) % 10][:60]
    rows = [(i, " ".join(words * 6)) for i in train] + [(held[0], " ".join(words * 5)), (held[1], "\n " + " \t".join(words * 5))]
    rows += [(i, " ".join(rng.permutation(words * 5))) for i in held[2:]]
    got = {r.doc_id: r for r in lm_score.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held[0]].held_out and abs(got[held[0]].score - got[held[1]].score) < 1e-9
    assert all(abs(got[i].base_score - got[held[0]].base_score) < 1e-9 for i in held)
    assert all(got[held[0]].score > 0.5 * got[i].score and got[held[0]].score > got[i].score + 5 for i in held[2:])
