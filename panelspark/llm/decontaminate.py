"""Benchmark decontamination by SimHash over item-sized windows.

Words are lower-cased (A-Z); shingles are five words.  Every window of a document as long as a
benchmark item gets a ``BITS``-bit SimHash of its weighted shingles; the items of that length are indexed by
``BITS / 4`` blocks of four bits.  Two fingerprints that differ in at most
``RADIUS = BITS / 4 - 1`` bits agree in at least one whole block, so the index returns
every item within the radius.  Candidates within the radius are verified by the exact
weighted-shingle similarity (sum of minimum over sum of maximum weight) of
window and item, which must reach 75 %.  Windows that share no shingle with any
item of their length have similarity 0 and are not fingerprinted.

A shingle weighs ``64 / (1 + ln df)`` (rounded), ``df`` being the number of
benchmark items that hold it; shingles that occur in no item or one weigh 64.
Fingerprints follow the cosine, the check the weighted Jaccard measure: shingles enter a
fingerprint with the square root of their weight, so that similarity s means a cosine of
at least 2 s / (1 + s), whatever the weights.

The benchmark is the stated query set: it is cut into blocks of bounded
size, and each block is broadcast and held against all documents in one pass
without a shuffle.

Defined cases: null and empty texts and items match nothing; an item of fewer than
five words matches documents that hold its words in a row (similarity 1); a
document shorter than an item is one window; of equally similar windows the first
is reported; repeated rows are reported each; very long texts are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import lower_ascii, mix64, staged, text_chunks, word_hashes, word_spans
from panelspark.llm.supers import MULT1, Prefix

SHINGLE = 5                 # fixed values: words a shingle, similarity in percent
PERCENT = 75
BITS = 256
RADIUS = BITS // 4 - 1
UNIT = 64                   # weight of a shingle of one item
BLOCK_ITEMS = 20_000        # bounds of a broadcast block of the benchmark
BLOCK_BYTES = 8_000_000
STRETCH = 4096              # words whose windows are summed at once


def _grams(hashes: np.ndarray, k: int) -> np.ndarray:
    return mix64(Prefix(hashes, MULT1).grams(k) + np.uint64(k))


def _item_grams(batches):
    """(item_id, n_words, grams) of every item; the grams in order, as bytes."""
    for batch in batches:
        ids, words, grams = [], [], []
        for i, starts, buf in text_chunks(batch.column("text")):
            low = lower_ascii(buf)
            a, b, first = word_spans(low, starts)
            h = word_hashes(low, a, b)
            for j in range(len(starts) - 1):
                own = h[first[j]:first[j + 1]]
                if len(own):
                    ids.append(batch.column("item_id")[i + j].as_py())
                    words.append(len(own))
                    grams.append(_grams(own, min(SHINGLE, len(own))).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(words, pa.int32()), pa.array(grams, pa.list_(pa.int64()))],
            ["item_id", "n_words", "grams"])


def _signs(grams: np.ndarray) -> np.ndarray:
    """(grams, BITS) of +1 / -1."""
    h = np.stack([mix64(grams + np.uint64((0xA24BAED4963EE407 * (i + 1)) % 2 ** 64)) for i in range(BITS // 64)], 1)
    return np.unpackbits(h.view(np.uint8), axis=1).astype(np.int32) * 2 - 1


def _root(weights: np.ndarray) -> np.ndarray:
    """Weights in a fingerprint: square roots in sixteenths."""
    return np.rint(16 * np.sqrt(weights)).astype(np.int32)


def _fingerprint(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed bits and their four-bit blocks."""
    packed = np.packbits(sums > 0, axis=1)
    return packed, np.stack([packed >> 4, packed & 15], 2).reshape(len(packed), -1)


class Index:
    """One block of the benchmark: rows (item_id, n_words, grams, df of each gram)."""

    def __init__(self, rows: list):
        self.short: dict = {}
        by_len: dict = {}
        grams, weights, lengths = [], [], []
        for item_id, n, g, df in sorted(rows, key=lambda r: (r[1], r[0])):
            g = np.array(g, np.int64).astype(np.uint64)
            if n < SHINGLE:
                self.short.setdefault(n, {}).setdefault(int(g[0]), []).append(item_id)
                continue
            w = np.rint(UNIT / (1 + np.log(np.array(df, np.float64)))).astype(np.int64)
            by_len.setdefault(n, []).append((item_id, g, w))
            grams.append(g)
            weights.append(w)
            lengths.append(np.full(len(g), n))
        g = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        w = np.concatenate(weights) if weights else np.zeros(0, np.int64)
        n = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
        self.grams, at = np.unique(g, return_index=True)
        self.weights = w[at]
        pairs = np.unique(np.stack([np.searchsorted(self.grams, g), n], 1), axis=0) if len(g) else np.zeros((0, 2), np.int64)
        self.lengths = pairs[:, 1]                       # item lengths that hold a gram
        self.length_at = np.searchsorted(pairs[:, 0], np.arange(len(self.grams) + 1))
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.grams >> np.uint64(44)).astype(np.int64)] = True
        self.by_len = {}
        for n, items in by_len.items():
            prints = [_fingerprint((_signs(g) * _root(w)[:, None]).sum(0)[None, :]) for _, g, w in items]
            packed = np.concatenate([p[0] for p in prints])
            cells = np.concatenate([p[1] for p in prints])
            table = np.zeros((BITS // 4, 16, len(items)), bool)      # block, value -> items
            table[np.arange(BITS // 4)[None, :], cells, np.arange(len(items))[:, None]] = True
            self.by_len[n] = ([i[0] for i in items], [i[1] for i in items], packed, table)

    def find(self, g: np.ndarray):
        """Positions of grams of the index, and their row in it."""
        maybe = np.flatnonzero(self.filter[(g >> np.uint64(44)).astype(np.int64)])
        if not len(maybe):
            return maybe, maybe
        row = np.searchsorted(self.grams, g[maybe])
        ok = (row < len(self.grams)) & (self.grams[np.minimum(row, len(self.grams) - 1)] == g[maybe])
        return maybe[ok], row[ok]

    def weight(self, g: np.ndarray) -> np.ndarray:
        out = np.full(len(g), UNIT, np.int64)
        at, row = self.find(g)
        out[at] = self.weights[row]
        return out

    def matches(self, hashes: np.ndarray, at: np.ndarray, row: np.ndarray, g: np.ndarray) -> dict:
        """Best (similarity, -start, words) per item for one document whose gram
        ``at[i]`` is row ``row[i]`` of the index."""
        best: dict = {}
        starts_of: dict = {}
        for p, r in zip(at.tolist(), row.tolist()):
            for n in self.lengths[self.length_at[r]:self.length_at[r + 1]].tolist():
                lo, hi = max(0, p - (n - SHINGLE)), min(p, max(0, len(hashes) - n))
                starts_of.setdefault(n, []).append((lo, hi))
        for n, spans in starts_of.items():
            starts: list = []
            end = -1
            for lo, hi in spans:                        # spans come in order of their starts
                starts += range(max(lo, end + 1), hi + 1)
                end = max(end, hi)
            a = 0
            while a < len(starts):
                z = a + int(np.searchsorted(starts[a:], starts[a] + STRETCH))
                self._windows(n, np.array(starts[a:z]), g, best)
                a = z
        return best

    def _windows(self, n: int, starts: np.ndarray, g: np.ndarray, best: dict) -> None:
        ids, items, packed, table = self.by_len[n]
        base = starts[0]
        width = min(n - SHINGLE + 1, len(g))
        own = g[base:starts[-1] + width]
        weight = self.weight(own)
        sums = np.zeros((len(own) + 1, BITS), np.int32)
        np.cumsum(_signs(own) * _root(weight)[:, None], axis=0, out=sums[1:])
        prints, cells = _fingerprint(sums[starts - base + width] - sums[starts - base])
        some = table[np.arange(BITS // 4)[None, :], cells].any(1)            # windows x items
        w, i = np.nonzero(some)
        near = np.bitwise_count(prints[w] ^ packed[i]).sum(1, dtype=np.int64) <= RADIUS
        for w, i in zip(w[near].tolist(), i[near].tolist()):
            s = int(starts[w])
            sim = self._similarity(g[s:s + width], items[i])
            if sim is not None:
                best[ids[i]] = max(best.get(ids[i], (0.0, 0, 0)), (sim, -s, min(n, width + SHINGLE - 1)))

    def _similarity(self, x: np.ndarray, y: np.ndarray) -> float | None:
        u, at = np.unique(np.concatenate([x, y]), return_inverse=True)
        cx = np.bincount(at[:len(x)], minlength=len(u))
        cy = np.bincount(at[len(x):], minlength=len(u))
        w = self.weight(u)
        low, high = int((w * np.minimum(cx, cy)).sum()), int((w * np.maximum(cx, cy)).sum())
        return low / high if 100 * low >= PERCENT * high else None

    def scan(self, buf: np.ndarray, starts: np.ndarray) -> dict:
        """{row of the chunk: {item_id: (similarity, -start, words)}}."""
        low = lower_ascii(buf)
        a, b, first = word_spans(low, starts)
        h = word_hashes(low, a, b)
        out: dict = {}
        g = _grams(h, SHINGLE)
        at, row = self.find(g)
        doc = np.searchsorted(first, at, "right") - 1
        inside = at + SHINGLE <= first[doc + 1]
        at, row, doc = at[inside], row[inside], doc[inside]
        for j in np.unique(doc).tolist():
            mine = slice(*np.searchsorted(doc, [j, j + 1]))
            s, e = first[j], first[j + 1]
            got = self.matches(h[s:e], at[mine] - s, row[mine], g[s:e - SHINGLE + 1])
            if got:
                out[j] = got
        for k, items in self.short.items():
            g = _grams(h, k)
            known = np.array(sorted(items), np.uint64)
            for p in np.flatnonzero(np.isin(g, known)).tolist():
                j = int(np.searchsorted(first, p, "right") - 1)
                if p + k <= first[j + 1]:
                    for item in items[int(g[p])]:
                        out.setdefault(j, {}).setdefault(item, (1.0, -(p - int(first[j])), k))
        return out


def benchmark_blocks(benchmark: DataFrame):
    """Index of every bounded block of the benchmark (item_id, text)."""
    g = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id is not null").mapInArrow(
        _item_grams, "item_id bigint, n_words int, grams array<bigint>")
    g = staged(g.withColumn("row", F.xxhash64("item_id", "grams")), "items")
    each = g.select("row", "item_id", F.posexplode("grams").alias("p", "gram"))
    df = each.groupBy("gram").agg(F.countDistinct("item_id").alias("df"))
    with_df = (each.join(df, "gram").groupBy("row", "item_id")
               .agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "df"))), lambda x: x["df"]).alias("df")))
    g = staged(g.dropDuplicates(["row", "item_id"]).join(with_df, ["row", "item_id"]), "items")
    size = g.agg(F.count("*").alias("n"), F.sum(F.size("grams") * 16).alias("b")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["b"] or 0) // BLOCK_BYTES))
    for k in range(blocks):
        rows = g.filter(F.pmod("row", F.lit(blocks)) == k).select("item_id", "n_words", "grams", "df").collect()
        if rows:
            yield Index([tuple(r) for r in rows])


def _find(shared):
    def run(batches):
        index = shared.value
        for batch in batches:
            doc, item, start, words, sim = [], [], [], [], []
            for i, starts, buf in text_chunks(batch.column("text")):
                for j, got in index.scan(buf, starts).items():
                    d = batch.column("doc_id")[i + j].as_py()
                    for k, (s, at, n) in sorted(got.items()):
                        doc.append(d), item.append(k), start.append(-at), words.append(n), sim.append(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(start, pa.int64()),
                 pa.array(words, pa.int32()), pa.array(sim, pa.float64())],
                ["doc_id", "item_id", "start_word", "n_words", "similarity"])
    return run


def _drop(shared):
    def run(batches):
        index = shared.value
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for i, starts, buf in text_chunks(batch.column("text")):
                for j in index.scan(buf, starts):
                    keep[i + j] = False
            yield batch.filter(pa.array(keep))
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_word, n_words, similarity: the best window of every
    document and item that meet the threshold."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    schema = "doc_id bigint, item_id bigint, start_word bigint, n_words int, similarity double"
    for index in benchmark_blocks(benchmark):
        part = d.mapInArrow(_find(docs.sparkSession.sparkContext.broadcast(index)), schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns, unchanged) that hold no benchmark item."""
    for index in benchmark_blocks(benchmark):
        docs = docs.mapInArrow(_drop(docs.sparkSession.sparkContext.broadcast(index)), docs.schema)
    return docs
