"""Language-model scoring by logistic mixing of hashed-context bit predictors.

A text is a sequence of words and one end token.  A word is coded byte by byte,
with a closing byte, and a byte bit by bit; the end token is the closing byte alone.
Five predictors give the odds of the next bit from hashed contexts: the last 1,
2, 3 and 5 bytes, which reach over closing bytes into the words before, and the word so
far.  A closing byte stands before the first word.  Only the first four symbols of a word see
what stands before its closing byte, so every distinct head (those symbols and the five bytes before
them) and, from the fifth symbol on, every distinct word of the corpus is coded once; a text's
score is the sum over its heads and words.  Their stretched probabilities are summed with
weights gated by how often the word so far has been seen; a last table refines the
mix by bit position and confidence.

Training covers all training documents and all their words: words and heads are counted over the
whole corpus, and every distinct one adds its count to the contexts of its symbols.
Contexts are exact (56 bits of hash, no shared slots) and as many as the corpus has: the
words and heads are cut into chunks, every chunk sends its (context, symbol) counts to buckets of the
hash range, a bucket adds them in int64 and sends each chunk the counts on its symbols'
paths.  No task and not the driver holds the counts of all contexts.
Weights and refinement, a logistic regression of a few thousand numbers, are learned online, in
mini-batches over all distinct training words and heads, with its own
occurrence taken out of the counts it is predicted from; the tasks' weights are
averaged.  Scoring uses the frozen
model.  The results reach the documents in two ways: the (bounded) list of
the most frequent words and heads is broadcast, all others are joined by hash.

Defined cases: null and empty texts hold the end token only; rows with the same id
and text are scored alike and stay separate rows; without training documents
all counts are 0 and every bit costs one bit; texts and words are taken whole, runs of
white space as one closing byte.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import MIX_B, MULT, doc_bucket, lower_ascii, mix64, release, staged, text_chunks, word_hashes, word_spans
from panelspark.llm.supers import MULT1, Prefix

TABLE_BITS = (16, 18, 19, 20, 20)       # slots of the tables of a model held in one process
CONTEXT_BYTES = (1, 2, 3, 5, 0)         # bytes of context; 0: the word so far
CHUNK_SYMBOLS = 1 << 17                 # symbols of the vocabulary handled together
BUCKET_KEYS = 1 << 19                   # (context, symbol) counts added together, about
BATCH_BYTES = 4 << 20                   # of an Arrow batch
GATE_COUNTS = (1, 4, 16, 64, 512, 8192)  # the weights are chosen by the count behind the last predictor
GATES = (len(GATE_COUNTS) + 1) * 6     # by it, by whether only one bit was ever seen, and by the place in the byte
START_WEIGHTS = ((.10, .30, .35, .30, .00), (.05, .25, .30, .30, .20), (.03, .20, .25, .25, .35), (.00, .10, .15, .20, .60),
                 (.00, .05, .10, .10, .80), (.00, .00, .00, .05, .95), (.00, .00, .00, .00, 1.0))
PREFIX_MIN = 2                          # words counted less often do not enter the last predictor
STEPS = 33                              # buckets of the refinement table
RATE = 0.2
PRIOR = 0.02
BATCH_SYMBOLS = 1 << 13
COUNT_TOKENS = 2_000_000                # tokens counted together before they are sent on
TOP_WORDS = 1_000_000                   # bound of the broadcast list
END = 32                                # fixed value: the byte that closes a word
REACH = max(CONTEXT_BYTES)              # bytes before a word that its contexts hold
HEAD = REACH - 1                        # symbols of a word that see more before it than its closing byte
PLAIN, WORDS, HEADS = range(3)          # units: words on their own; words, coded from symbol HEAD on; the first HEAD symbols


# ------------------------------------------------------------------ counting

def _gather(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Binary array of the byte ranges [a, b)."""
    n = b - a
    off = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    pos = np.repeat(a - off[:-1], n) + np.arange(int(off[-1]))
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(buf[pos].tobytes())])


def _running(low: np.ndarray, a: np.ndarray, b: np.ndarray, first: np.ndarray):
    """The texts as the model reads them, a closing byte before the first and after every word:
    (bytes, start of every word, and start and end of every text's bytes; the end token follows)."""
    n = b - a
    begin = np.concatenate([[0], np.cumsum(n + 1)])
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.full(int(begin[-1]) + len(first) - 1, END, np.uint8)
    at = begin[:-1] + text + 1
    out[np.repeat(at - begin[:-1] + np.arange(len(n)), n) + np.arange(int(n.sum()))] = low[np.repeat(a - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
    return out, at, begin[first[:-1]] + np.arange(len(first) - 1), begin[first[1:]] + np.arange(1, len(first))


def heads_of(low: np.ndarray, a: np.ndarray, b: np.ndarray, first: np.ndarray):
    """(bytes, start, end, bytes before) of the heads of all words, then of the texts' end tokens:
    up to REACH bytes before the word and HEAD of its own."""
    out, at, lo, hi = _running(low, a, b, first)
    mine = np.concatenate([at, hi])
    left = mine - np.maximum(np.concatenate([np.repeat(lo, np.diff(first)), lo]), mine - REACH)
    return out, mine - left, mine + np.concatenate([np.minimum(b - a, HEAD), np.zeros(len(hi), np.int64)]), left


def head_hashes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, left: np.ndarray) -> np.ndarray:
    return mix64(word_hashes(buf, a, b) + left.astype(np.uint64) * MULT)


class _Counter:
    """Distinct words and heads of the texts seen so far, by hash."""

    def __init__(self):
        self.parts: list = []
        self.size = 0

    def add(self, low, a, b, left, h, train):
        for flag in (True, False):
            m = train == flag
            if m.any():
                u, at, c = np.unique(h[m], return_index=True, return_counts=True)
                self.parts.append((flag, u, c, left[m][at], _gather(low, a[m][at], b[m][at])))
                self.size += len(u)

    def merge(self) -> None:
        """Every distinct one once."""
        merged = []
        for flag in (True, False):
            own = [p for p in self.parts if p[0] == flag]
            if own:
                u, at, inv = np.unique(np.concatenate([p[1] for p in own]), return_index=True, return_inverse=True)
                c = np.bincount(inv, np.concatenate([p[2] for p in own]).astype(float)).astype(np.int64)
                words = pa.concat_arrays([p[4] for p in own]).take(pa.array(at))
                merged.append((flag, u, c, np.concatenate([p[3] for p in own])[at], words))
        self.parts, self.size = merged, sum(len(p[1]) for p in merged)

    def rows(self):
        self.merge()
        for flag, _, c, left, words in self.parts:
            yield pa.RecordBatch.from_arrays([pa.array(left.astype(np.int32)), words, pa.array(c if flag else np.zeros(len(c), np.int64)),
                                              pa.array(c)], UNIT_NAMES)
        self.parts, self.size = [], 0


UNIT_NAMES = ["n_left", "word", "c_train", "c_all"]
UNITS = "n_left int, word binary, c_train bigint, c_all bigint"


def _count_units(batches):
    counter = _Counter()
    ends = [0, 0]
    for batch in batches:
        train = ~np.array(batch.column("held_out").to_pylist(), bool)
        ends[0] += int(train.sum())
        ends[1] += len(train)
        for i, starts, buf in text_chunks(batch.column("text")):
            low = lower_ascii(buf)
            a, b, first = word_spans(low, starts)
            own = train[i:i + len(first) - 1]
            each = np.repeat(own, np.diff(first))
            counter.add(low, a, b, np.zeros(len(a), np.int32), word_hashes(low, a, b), each)
            out, lo, hi, left = heads_of(low, a, b, first)
            counter.add(out, lo, hi, left, head_hashes(out, lo, hi, left), np.concatenate([each, own]))
            if counter.size > COUNT_TOKENS:
                counter.merge()
                if counter.size > COUNT_TOKENS // 2:
                    yield from counter.rows()
    yield from counter.rows()
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([b""], pa.binary()), pa.array([ends[0]]), pa.array([ends[1]])],
                                     UNIT_NAMES)


def units(d: DataFrame) -> DataFrame:
    """Distinct words (no byte before them) and heads of the texts of ``d`` (held_out, text), with their counts."""
    return (d.select("held_out", "text").mapInArrow(_count_units, UNITS)
            .groupBy("n_left", "word").agg(F.sum("c_train").alias("c_train"), F.sum("c_all").alias("c_all")))


# ------------------------------------------------------------------ the model

def symbols_of(words: pa.Array, left: np.ndarray | None = None):
    """Flat symbols of the words, each closed by END, and for every symbol the
    slot hashes of its contexts: (symbols, starts, hashes (5, symbols)).
    The first ``left`` bytes of a word stand before it and are context only."""
    words = words.cast(pa.large_binary())
    off = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] is not None else np.zeros(0, np.uint8)
    raw = raw[off[0]:off[-1]]
    left = np.zeros(len(words), np.int64) if left is None else left.astype(np.int64)
    n = np.diff(off)
    starts = np.concatenate([[0], np.cumsum(n + 1)])
    sym = np.full(int(starts[-1]), END, np.uint8)
    inner = np.ones(len(sym), bool)
    inner[starts[1:] - 1] = False
    sym[inner] = raw
    back = np.arange(len(sym)) - np.repeat(starts[:-1], n + 1)
    within = back - np.repeat(left, n + 1)
    prefix = Prefix(sym.astype(np.uint64) + np.uint64(1), MULT1)
    here = np.flatnonzero(within >= 0)
    back, within = back[here], within[here]
    ctx = np.zeros((len(CONTEXT_BYTES), len(here)), np.uint64)
    for k, width in enumerate(CONTEXT_BYTES):
        reach = np.minimum(back, width) if width else within
        short = np.minimum(reach, width or 255).astype(np.uint64)
        ctx[k] = mix64(prefix.ranges(here - reach, here) + short * np.uint64(0x51ED270B35A1F7C5) + np.uint64(k + 1))
    return sym[here], starts - np.concatenate([[0], np.cumsum(left)]), ctx


def slots(ctx: np.ndarray, k: int, node: np.ndarray) -> np.ndarray:
    """Slot of the bit node (1..255) in predictor ``k``'s table; the first
    predictor's contexts are few and its table has one slot for each."""
    return (((ctx + node * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93))
            >> np.uint64(64 - TABLE_BITS[k])).astype(np.int64)


def _bits(sym: np.ndarray):
    """For each of the 8 bits, high first: (node, bit)."""
    s = sym.astype(np.int64)
    for j in range(8):
        yield ((1 << j) | (s >> (8 - j))).astype(np.uint64), (s >> (7 - j)) & 1


# ------------------------------------------------------------------ contexts

CHUNK_SCHEMA = "src bigint, kind int, n_left binary, size binary, raw binary, c_train binary, c_all binary"


def _pack(kind: int):
    """The units in rows of about CHUNK_SYMBOLS symbols, numbered."""
    def run(batches):
        part, n = kind << 60 | TaskContext.get().partitionId() << 32, 0
        held: list = []
        for batch in batches:
            words = batch.column("word").cast(pa.large_binary())
            left = batch.column("n_left")
            if kind == WORDS:                                       # their contexts begin with the closing byte before
                close = pa.scalar(bytes([END]), pa.large_binary())
                words = pa.compute.binary_join_element_wise(close, words, pa.scalar(b"", pa.large_binary()))
                left = pa.array(np.ones(len(words), np.int32))
            for a, b in _slices(words, CHUNK_SYMBOLS):
                held.append([c.slice(a, b - a) for c in (left, words, batch.column("c_train"), batch.column("c_all"))])
                if sum(len(w) + pa.compute.sum(pa.compute.binary_length(w)).as_py() for _, w, _, _ in held) >= CHUNK_SYMBOLS:
                    yield _chunk(part + n, kind, held)
                    held, n = [], n + 1
        if held:
            yield _chunk(part + n, kind, held)
    return run


def _chunk(src: int, kind: int, held: list) -> pa.RecordBatch:
    left, words, train, both = (pa.concat_arrays([h[k] for h in held]) for k in range(4))
    sizes = pa.compute.binary_length(words)
    raw = b"".join(words.to_pylist())
    left, sizes, train, both = (_small(c.to_numpy(zero_copy_only=False)) for c in (left, sizes, train, both))
    return pa.RecordBatch.from_arrays(
        [pa.array([src], pa.int64()), pa.array([kind], pa.int32()), *[pa.array([c], pa.binary()) for c in (left, sizes, raw, train, both)]],
        ["src", "kind", "n_left", "size", "raw", "c_train", "c_all"])


def _unpack(row: dict):
    """(words, bytes before them, c_train, c_all) of a chunk."""
    left, sizes, train, both = (_wide(row[c]) for c in ("n_left", "size", "c_train", "c_all"))
    off = np.concatenate([[0], np.cumsum(sizes)])
    words = pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off.tobytes()), pa.py_buffer(row["raw"])])
    return words, left, train, both


def coded(kind: int, starts: np.ndarray):
    """Which symbols of the units are theirs to code, and which of them a predictor has pairs for: whole words
    also count all their symbols for the word so far."""
    within = np.arange(int(starts[-1])) - np.repeat(starts[:-1], np.diff(starts))
    m = within < HEAD if kind == HEADS else within >= (HEAD if kind == WORDS else 0)
    return m, np.stack([m if width or kind == HEADS else np.ones(len(m), bool) for width in CONTEXT_BYTES])


def _rows(batch):
    """One row at a time: a chunk's counts take some MB."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def keys_of(sym: np.ndarray, ctx: np.ndarray, used: np.ndarray):
    """The distinct (context, symbol) pairs, 56 bits of context and the symbol, and for
    every predictor and symbol the place of its pair (0 where it is not ``used``)."""
    own = mix64(ctx + np.arange(len(ctx), dtype=np.uint64)[:, None] * MIX_B)     # predictors share no contexts
    seen = pa.array(((own & ~np.uint64(255)) | sym)[used]).dictionary_encode()
    u = seen.dictionary.to_numpy()
    order = np.argsort(u)
    place = np.empty(len(u), np.int64)
    place[order] = np.arange(len(u))
    at = np.zeros(ctx.shape, np.int64)
    at[used] = place[seen.indices.to_numpy()]
    return u[order], at


def add_up(at: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``counts`` by place, in int64."""
    out = np.zeros(size, np.int64)
    np.add.at(out, at.ravel(), counts.ravel())
    return out


def path_counts(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(9, keys): how often the context of each (sorted) pair was followed by a
    symbol that shares its first 0..8 bits."""
    out = np.empty((9, len(keys)), np.int64)
    for j in range(9):
        node = keys >> np.uint64(8 - j)
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(keys) else np.zeros(0, np.int64)
        if len(first):
            out[j] = np.repeat(np.add.reduceat(counts, first), np.diff(np.append(first, len(keys))))
    return out


def _small(x: np.ndarray) -> bytes:
    """How many numbers, then compressed: each in a byte, and those that need more behind them."""
    x = x.ravel()
    raw = np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].astype(np.int64).tobytes()
    return np.array([len(x), len(raw)], np.int64).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _wide(b: bytes) -> np.ndarray:
    n, size = np.frombuffer(b, np.int64, 2).tolist()
    raw = pa.decompress(pa.py_buffer(b)[16:], size, "zstd")
    x = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    x[x == 255] = np.frombuffer(raw, np.int64, offset=n)
    return x


def _steps(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences, byte by byte: the leading bytes are 0 and compress."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _keys(b) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def _send(bits: int):
    """One row per chunk and bucket: the chunk's pairs of the bucket and their counts."""
    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                words, left, train, _ = _unpack(row)
                sym, starts, ctx = symbols_of(words, left)
                _, used = coded(row["kind"], starts)
                keys, at = keys_of(sym, ctx, used)
                w = np.repeat(train, np.diff(starts))
                # the word so far is counted by the whole words, the bytes before it by the units that code the symbol
                often = np.where((w >= PREFIX_MIN) & (row["kind"] != HEADS), w, 0)
                counts = add_up(at[used], np.stack([w if width else often for width in CONTEXT_BYTES])[used], len(keys))
                cut = np.searchsorted((keys >> np.uint64(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
                full = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(full), row["src"]), pa.int64()), pa.array(full.astype(np.int32)),
                     pa.array([_steps(keys[cut[k]:cut[k + 1]]) for k in full], pa.binary()),
                     pa.array([_small(counts[cut[k]:cut[k + 1]]) for k in full], pa.binary())],
                    ["src", "bucket", "keys", "counts"])
    return run


def _add_bucket(table: pa.Table) -> pa.Table:
    """Adds the chunks' counts of a bucket; every chunk gets the paths of its pairs."""
    sent = [_keys(k.as_buffer()) for k in table["keys"]]
    counts = np.concatenate([_wide(c.as_py()) for c in table["counts"]])
    keys, at = np.unique(np.concatenate(sent), return_inverse=True)
    paths = path_counts(keys, add_up(at, counts, len(keys)))
    paths[:8] -= paths[1:]                                   # the other bit's counts, mostly 0, and the symbol's own
    ends = np.cumsum([len(k) for k in sent])
    return pa.table({"src": table["src"], "bucket": table["bucket"],
                     "paths": pa.array([_small(paths[:, at[e - len(k):e]]) for k, e in zip(sent, ends)], pa.binary())})


def _join_chunk(table: pa.Table) -> pa.Table:
    """A chunk with the paths of all its pairs in the order of its keys."""
    rows = table.select(["bucket", "paths"]).to_pylist()
    paths = [_wide(r["paths"]).reshape(9, -1) for r in sorted(rows, key=lambda r: r["bucket"]) if r["bucket"] >= 0]
    own = table.filter(pa.compute.less(table["bucket"], 0)).drop_columns(["bucket", "paths"])
    return own.append_column("paths", pa.array([_small(np.concatenate(paths, 1))], pa.binary()))


def _counted(row: dict):
    """(starts, counts) of the symbols that a chunk's units code; counts are the two of ``followed`` and for every
    predictor and symbol the place of its pair in them, the symbols themselves as last row."""
    words, left, _, _ = _unpack(row)
    sym, starts, ctx = symbols_of(words, left)
    m, used = coded(row["kind"], starts)
    _, at = keys_of(sym, ctx, used)
    at = np.concatenate([at[:, m], sym[None, m].astype(np.int64)])
    return np.concatenate([[0], np.cumsum(m)])[starts], (*followed(row.pop("paths")), at)


def _with_counts(batches):
    """(words, c_train, c_all, starts, counts) of every chunk."""
    for batch in batches:
        for row in _rows(batch):
            words, _, train, both = _unpack(row)
            yield words, train, both, *_counted(row)


def followed(paths: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(pairs sharing the first 0..8 bits, the other bit's pairs) of a chunk, in the narrowest integers
    that hold sums of both."""
    wide = _wide(paths).reshape(9, -1)
    most = int(wide.sum(0).max(initial=0))
    other = wide.astype(np.int32 if 2 * most < 1 << 31 else np.int64)
    del wide
    own = other.copy()
    for j in range(7, -1, -1):
        own[j] += own[j + 1]
    return own, other


def stretch(p):
    return np.log(p / (1 - p))


def squash(x):
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


def place_of(node: np.ndarray) -> int:
    return 0 if node[0] < 2 else 1 if node[0] < 8 else 2


class Mixer:
    """Gated weights and refinement over counts of the predictors' contexts: given with the
    symbols, or, for a model held in one process, in ``tables[k]`` of (n0, n1) pairs."""

    def __init__(self, tables: list[np.ndarray] | None = None):
        self.tables = tables
        self.weights = np.repeat(np.array(START_WEIGHTS), 6, 0)
        self.seen = np.zeros(GATES)
        self.steps = np.zeros(GATES)
        knots = squash((np.arange(STEPS) - STEPS // 2) * 0.5)
        self.fine = np.stack([np.tile(1 - knots, (256, 1)), np.tile(knots, (256, 1))], 2) * 4.0     # node, step, bit
        self.rates = (self.fine[:, :, 1] / self.fine.sum(2)).ravel()

    def odds(self, own, other, less: int = 0):
        """For the 8 bits, of every pair the stretched odds of its symbol's bit and the gate if the pair is the last
        predictor's.  own[j + 1] and other[j] are how often the coded bit and the other one followed;
        ``less`` occurrences of the coded unit are taken out first."""
        x = np.empty((8, own.shape[1]), np.float32)
        gate = np.empty((8, own.shape[1]), np.uint8)
        for j in range(8):
            mine = np.maximum(own[j + 1] - less, 0)
            x[j] = np.log((mine.astype(np.float32) + np.float32(PRIOR)) / (other[j].astype(np.float32) + np.float32(PRIOR)))
            gate[j] = self._gate(mine, other[j])
        return x, gate

    def inputs(self, j, node, bit, odds, at):
        """Stretched odds of the predictors and the gate for bit ``j`` of the symbols, from the places of their pairs."""
        x = odds[0][j].take(at[:-1], mode="clip")
        x *= (2 * bit - 1).astype(np.float32)
        return x, odds[1][j].take(at[-2], mode="clip") + place_of(node)

    def table_inputs(self, ctx, node):
        """The same from the model's own tables."""
        x = np.empty(ctx.shape, np.float32)
        for k in range(len(x)):
            at = slots(ctx[k], k, node) * 2
            n0, n1 = self.tables[k][at], self.tables[k][at + 1]
            x[k] = np.log((n1 + PRIOR) / (n0 + PRIOR))
        return x, self._gate(n0, n1) + place_of(node)

    def mixed(self, x, gate):
        return np.einsum("kn,kn->n", self.weights.T.take(gate, 1), x)

    def refined(self, node, z):
        """Mean of the mix and its refinement, and the two buckets it lies between."""
        pos = np.clip(z / 0.5 + STEPS // 2, 0, STEPS - 1.001)
        lo = pos.astype(np.int64)
        f = pos - lo
        at = node.astype(np.int64) * STEPS + lo
        q = self.rates[at] * (1 - f) + self.rates[at + 1] * f
        return np.clip((squash(z) + q) / 2, 1e-6, 1 - 1e-6), lo, f

    def freeze(self) -> "Mixer":
        """Refinement as probabilities."""
        self.rates = (self.fine[:, :, 1] / self.fine.sum(2)).ravel()
        return self

    @staticmethod
    def _gate(n0, n1):
        return (np.searchsorted(GATE_COUNTS, n0 + n1, "right") * 2 + (np.minimum(n0, n1) == 0)) * 3

    def learn(self, weight: np.ndarray, odds, at: np.ndarray) -> None:
        """One mini-batch of an online pass; the last row of ``at`` holds the symbols."""
        for j, (node, bit) in enumerate(_bits(at[-1])):
            x, gate = self.inputs(j, node, bit, odds, at)
            z = self.mixed(x, gate)
            err = (bit - squash(z)) * weight
            mass = np.bincount(gate, weight, GATES)
            self.seen += mass
            self.steps += mass > 0
            # a batch with few occurrences takes a small step, one with very many no larger step than the mean
            usual = self.seen / np.maximum(self.steps, 1)
            for k in range(len(x)):
                self.weights[:, k] += RATE * np.bincount(gate, err * x[k], GATES) / np.maximum(np.maximum(mass, usual), 1)
            pos = np.clip(z / 0.5 + STEPS // 2, 0, STEPS - 1.001)
            lo = pos.astype(np.int64)
            f = pos - lo
            for step, share in ((lo, 1 - f), (lo + 1, f)):
                cell = (node.astype(np.int64) * STEPS + step) * 2 + bit
                self.fine += np.bincount(cell, share * weight, self.fine.size).reshape(self.fine.shape)

    def log10_prob(self, words: pa.Array) -> np.ndarray:
        """Of every word, with the frozen model and its own tables."""
        sym, starts, ctx = symbols_of(words)
        total = np.zeros(len(sym))
        for node, bit in _bits(sym):
            total += self._cost(node, bit, *self.table_inputs(ctx, node))
        return np.bincount(np.repeat(np.arange(len(words)), np.diff(starts)), total, len(words))

    def symbol_cost(self, odds, at: np.ndarray) -> np.ndarray:
        """log10 of the probability of every symbol, with the frozen model."""
        total = np.zeros(at.shape[1])
        for j, (node, bit) in enumerate(_bits(at[-1])):
            total += self._cost(node, bit, *self.inputs(j, node, bit, odds, at))
        return total

    def _cost(self, node, bit, x, gate):
        p, _, _ = self.refined(node, self.mixed(x, gate))
        return np.log10(np.where(bit == 1, p, 1 - p))


def _slices(words: pa.Array, size: int = BATCH_SYMBOLS):
    """Runs of words of about ``size`` symbols."""
    n = np.array(pa.compute.binary_length(words).to_numpy(zero_copy_only=False), np.int64) + 1
    run = np.cumsum(n) // size
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1, [len(n)]])
    return [(int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]


def _learn(batches):
    model = Mixer()
    start = model.fine.copy()
    for _, train, _, starts, (own, other, at) in _with_counts(batches):
        weight = np.repeat(train, np.diff(starts))
        at = at[:, weight > 0]
        weight = weight[weight > 0].astype(np.float64)
        odds = model.odds(own, other, 1)
        own = other = None
        for a in range(0, len(weight), BATCH_SYMBOLS):
            model.learn(weight[a:a + BATCH_SYMBOLS], odds, at[:, a:a + BATCH_SYMBOLS])
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.seen.tobytes()], pa.binary()),
         pa.array([(model.fine - start).tobytes()], pa.binary())], ["weights", "seen", "fine"])


def context_counts(vocab: DataFrame, n_symbols: int) -> DataFrame:
    """The units (n_left, word, c_train, c_all; without n_left, words on their own) in chunks, each with the counts on the
    paths of its symbols in all contexts: every (context, symbol) is added up by its bucket."""
    if "n_left" in vocab.columns:
        v = vocab.select("n_left", "word", "c_train", "c_all")
        chunks = (v.filter("n_left = 0").mapInArrow(_pack(WORDS), CHUNK_SCHEMA)
                  .union(v.filter("n_left > 0").mapInArrow(_pack(HEADS), CHUNK_SCHEMA)))
    else:
        chunks = vocab.select(F.lit(0).alias("n_left"), "word", "c_train", "c_all").mapInArrow(_pack(PLAIN), CHUNK_SCHEMA)
    chunks = staged(chunks, "chunks")
    bits = max(3, math.ceil(math.log2(max(1, n_symbols * len(CONTEXT_BYTES) / BUCKET_KEYS))))
    paths = (chunks.mapInArrow(_send(bits), "src bigint, bucket int, keys binary, counts binary")
             .groupBy("bucket").applyInArrow(_add_bucket, "src bigint, bucket int, paths binary"))
    both = (chunks.withColumn("bucket", F.lit(-1)).withColumn("paths", F.lit(None).cast("binary"))
            .unionByName(paths, allowMissingColumns=True))
    return staged(both.groupBy("src").applyInArrow(_join_chunk, CHUNK_SCHEMA + ", paths binary"), "paths")


def fit(chunks: DataFrame) -> Mixer:
    """Frozen model of the training words in ``context_counts``."""
    model = Mixer()
    # one small row a task; means and sums are formed in the order of the row's bytes
    parts = sorted((bytes(r["weights"]), bytes(r["seen"]), bytes(r["fine"])) for r in chunks.mapInArrow(
        _learn, "weights binary, seen binary, fine binary").collect())
    if parts:
        w = np.stack([np.frombuffer(p[0]).reshape(model.weights.shape) for p in parts])
        seen = np.stack([np.frombuffer(p[1]) for p in parts])
        share = np.where(seen.sum(0) > 0, seen / np.maximum(seen.sum(0), 1e-9), 1 / len(parts))
        model.weights = (w * share[:, :, None]).sum(0)
        for p in parts:
            model.fine = model.fine + np.frombuffer(p[2]).reshape(model.fine.shape)
    return model.freeze()


def _score_units(weights: np.ndarray, fine: np.ndarray):
    """(h, c_train, c_all, score) of every word, its score without its head's, and of every head, with -1 as c_train."""
    def run(batches):
        model = Mixer()
        model.weights, model.fine = weights, fine
        model.freeze()
        for batch in batches:
            for row in _rows(batch):
                words, left, train, both = _unpack(row)
                begin, (own, other, at) = _counted(row)
                odds = model.odds(own, other)
                own = other = None
                cost = np.zeros(at.shape[1])
                for a in range(0, len(cost), BATCH_SYMBOLS):
                    cost[a:a + BATCH_SYMBOLS] = model.symbol_cost(odds, at[:, a:a + BATCH_SYMBOLS])
                score = np.bincount(np.repeat(np.arange(len(words)), np.diff(begin)), cost, len(words))
                off, raw = np.frombuffer(words.buffers()[1], np.int64), np.frombuffer(row["raw"], np.uint8)
                if row["kind"] == HEADS:
                    h, train = head_hashes(raw, off[:-1], off[1:], left), np.full(len(words), -1)
                else:
                    h = np.zeros(len(words), np.uint64)
                    full = np.flatnonzero(np.diff(off) > left)
                    h[full] = word_hashes(raw, (off[:-1] + left)[full], off[1:][full])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.astype(np.int64)), pa.array(train), pa.array(both), pa.array(score)],
                    ["h", "c_train", "c_all", "score"])
    return run


# ------------------------------------------------------------------ documents

def lookup(top: np.ndarray, first_of: np.ndarray, h: np.ndarray):
    """(found, row) of every hash in the sorted list ``top``, from the places where
    its leading 20 bits begin."""
    b = (h >> np.uint64(44)).astype(np.int64)
    row, end = first_of[b], first_of[b + 1]
    found = np.zeros(len(h), bool)
    at = np.flatnonzero(row < end)
    while len(at):
        same = top[row[at]] == h[at]
        found[at[same]] = True
        at = at[~same]
        row[at] += 1
        at = at[row[at] < end[at]]
    return found, row


def _sum_known(shared):
    """Per document the sums over the end token and the frequent words and heads, and one row
    per other word or head: (doc_id, th, held_out, h, n, copies, n_tokens, n_known, base, score, n_bytes)."""
    def run(batches):
        top, c_train, s, end = shared.value
        val = ((c_train > 0).astype(float), np.where(c_train < 0, 0, np.log10(np.maximum(c_train, 0) + 0.1)), s.astype(float))
        first_of = np.searchsorted(top, np.arange((1 << 20) + 1, dtype=np.uint64) << np.uint64(44))
        first_of[-1] = len(top)
        for batch in batches:
            ids, th = batch.column("doc_id"), batch.column("th")
            held = batch.column("held_out")
            for i, starts, buf in text_chunks(batch.column("text")):
                low = lower_ascii(buf)
                a, b, first = word_spans(low, starts)
                n = np.diff(first)
                docs = len(n)
                owner = np.repeat(np.arange(docs), n)
                owner = np.concatenate([owner, owner, np.arange(docs)])
                h = np.concatenate([word_hashes(low, a, b), head_hashes(*heads_of(low, a, b, first))])
                hit, row = lookup(top, first_of, h)
                sums = [np.bincount(owner[hit], val[j][row[hit]], docs) + end[j] for j in range(3)]
                at = pa.array(np.arange(i, i + docs))
                zero = np.zeros(docs, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), th.take(at), held.take(at), pa.nulls(docs, pa.int64()), pa.array(zero),
                     pa.array(zero + 1), pa.array(n + 1), pa.array(np.rint(sums[0]).astype(np.int64)),
                     pa.array(sums[1]), pa.array(sums[2]), pa.array(np.diff(starts))], NAMES)
                miss = ~hit
                if miss.any():
                    pair = np.stack([owner[miss].astype(np.uint64), h[miss]], 1)
                    o = np.lexsort((pair[:, 1], pair[:, 0]))
                    pair = pair[o]
                    new = np.concatenate([[True], (pair[1:] != pair[:-1]).any(1)])
                    where = np.flatnonzero(new)
                    c = np.diff(np.append(where, len(pair)))
                    at = pa.array((pair[where, 0]).astype(np.int64) + i)
                    m = len(where)
                    zero = np.zeros(m, np.int64)
                    fz = np.zeros(m)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(at), th.take(at), held.take(at), pa.array(pair[where, 1].astype(np.int64)), pa.array(c),
                         pa.array(zero), pa.array(zero), pa.array(zero), pa.array(fz), pa.array(fz), pa.array(zero)], NAMES)
    return run


NAMES = ["doc_id", "th", "held_out", "h", "n", "copies", "n_tokens", "n_known", "base", "score", "n_bytes"]
SCHEMA = ("doc_id bigint, th bigint, held_out boolean, h bigint, n bigint, copies bigint, n_tokens bigint, "
          "n_known bigint, base double, score double, n_bytes bigint")


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))     # a chunk's counts take some MB
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.select("doc_id", "text", F.xxhash64("text").alias("th"), (doc_bucket(F.col("doc_id"), 10) == 0).alias("held_out"))
    vocab = staged(units(d), "vocab")
    word = F.col("n_left") == 0
    whole = vocab.agg(F.coalesce(F.sum(F.when(word, F.col("c_train"))), F.lit(0)).alias("n"),
                      F.count(F.when(word & (F.col("c_train") > 0), 1)).alias("v"),
                      F.coalesce(F.sum(F.octet_length("word") + 1), F.lit(0)).alias("symbols")).first()
    release(spark)
    chunks = context_counts(vocab.filter("c_all > 0"), whole["symbols"])
    release(spark)
    model = fit(chunks)
    scored = staged(chunks.mapInArrow(_score_units(model.weights, model.fine),
                                 "h bigint, c_train bigint, c_all bigint, score double"), "scored")
    # the end token is the empty word, all of it in its head
    last = scored.filter("h = 0").first()
    c_end = last["c_train"] if last else 0
    end = (float(c_end > 0), math.log10(c_end + 0.1), 0.0)
    words = scored.filter("h <> 0").withColumn("rank", F.floor(F.log2("c_all") * 8).cast("int"))
    cut, room = 0, TOP_WORDS
    for r in sorted(words.groupBy("rank").count().collect(), reverse=True):       # a few hundred classes of counts
        room -= r["count"]
        if room < 0:
            cut = r["rank"] + 1
            break
    top = words.filter(F.col("rank") >= cut).select("h", "c_train", F.col("score").cast("float").alias("score")).toArrow()
    key = top["h"].to_numpy().astype(np.uint64)
    o = np.argsort(key)
    c, s = top["c_train"].to_numpy()[o], top["score"].to_numpy()[o]
    release(spark)
    parts = d.mapInArrow(_sum_known(spark.sparkContext.broadcast((key[o], c, s, end))), SCHEMA)
    parts = staged(parts, "doc-parts")
    rare = (parts.filter("h is not null").select("doc_id", "th", "held_out", "h", "n")
            .join(words.filter(F.col("rank") < cut).select("h", "c_train", F.col("score").alias("s")), "h")
            .select("doc_id", "th", "held_out", F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_tokens"),
                    F.when(F.col("c_train") > 0, F.col("n")).otherwise(0).alias("n_known"),
                    F.when(F.col("c_train") >= 0, F.col("n") * F.log10(F.col("c_train") + 0.1)).otherwise(0.0).alias("base"), (F.col("n") * F.col("s")).alias("score"),
                    F.lit(0).cast("long").alias("n_bytes")))
    sums = (parts.filter("h is null").drop("h", "n").unionByName(rare).groupBy("doc_id", "th", "held_out")
            .agg(*[F.sum(c).alias(c) for c in NAMES[5:]]))
    # rows that repeat an id and text were added up: the mean of them, once per copy
    k = F.col("copies")
    sums = sums.withColumn("copy", F.explode(F.sequence(F.lit(1), k.cast("int"))))
    n, v = whole["n"], whole["v"]
    denom = math.log10(n + 0.1 * (v + 1))
    tokens = (F.col("n_tokens") / k).cast("long")
    score = F.col("score") / k
    size = F.col("n_bytes") / k
    return sums.select("doc_id", "held_out", tokens.alias("n_tokens"), (F.col("n_known") / k).cast("long").alias("n_known"),
                       F.lit(n).cast("long").alias("train_tokens"),
                       (F.col("base") / k - tokens * denom).alias("base_score"), score.alias("score"),
                       F.when(size > 0, -score * math.log2(10) / size).alias("bits_per_byte"))
