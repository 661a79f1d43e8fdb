"""Ranked lexical search by pipelined term partitioning.

Terms are split among ``STAGES`` owners, the rarest first and about equally many postings each.
A bundle of items with a shard of documents is one traveller: it carries sparse accumulators (item,
document, score) from owner to owner.  A stage is one cogroup of the travellers with
the owner's postings of the same bundle and shard; it adds integer contributions
and hands the accumulators on.  After the last stage the best rows of every bundle and shard are
selected, and a top-k window per item ends the search.

A traveller drops an accumulator once it cannot matter: if ten documents of
its shard already score more than this one could reach with all terms still to come (their
greatest contributions in the shard are known), it is not among the item's best ten.
This loses nothing: scores only grow.

Postings are written once, by one pass over the documents per block of items, packed per shard (term, documents,
occurrences).  A shard is a run of documents of one input partition, at most
``SHARD_DOCS`` documents or about ``SHARD_POSTINGS`` postings (one long document more), so a frequent term is split over all shards and no task holds
a term's whole list.  The dictionary of a block of items, at most about ``BLOCK_TERMS`` terms (or one item's), is the only thing
that is sent to all tasks; more items make more blocks, each of which is searched against all documents.

Scores: see ``contribution``.  All but the logarithm is 64-bit integer arithmetic.

Defined cases: null and empty texts have no term; documents without terms count nowhere; documents without an
id count in the statistics and are not ranked; rows that share a doc_id are documents of their
own; items that share an item_id are one item; items without an id or terms give no row; a document counts whole, whatever its length; an empty table on
either side gives an empty result; ties go to the smaller doc_id; other columns are ignored.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import staged, text_chunks, word_hashes, word_spans

TOP = 10
STAGES = 4
BUNDLE_ITEMS = 256
BLOCK_TERMS = 200_000
SHARD_DOCS = 8192
SHARD_POSTINGS = 2_000_000
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"     # fixed value: a term is a maximal match
BLOCK = "shard bigint, n_docs bigint, n_terms bigint, docs binary, lens binary, term binary, offs binary, doc binary, tf binary"
TRAVELLER = "bundle int, shard bigint, n_docs int, item binary, doc binary, score binary"


def _byte_map() -> np.ndarray:
    """A-Z to lower case, separators to a space, all else unchanged."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    # fixed values: ASCII other than digits and letters
    for lo, hi in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        out[lo:hi + 1] = 32
    return out


BYTE_MAP = _byte_map()


def terms_of(text) -> list[bytes]:
    """Terms of one text, in order, with repeats."""
    return BYTE_MAP[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split()


def contribution(w, tf, m):
    """w * ((1000000000 * tf) div (1000 * tf + 8 * m)), all integers."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_measure(n, n_docs: int, total: int):
    return 100 - 90 + (90 * n * n_docs) // total


class Dictionary:
    """Terms of a block of items, findable by the hash of their bytes and compared byte by byte."""

    def __init__(self, terms: list[bytes]):
        buf = np.frombuffer(b"".join(terms), np.uint8)
        n = np.array([len(t) for t in terms], np.int64)
        end = np.cumsum(n)
        h = word_hashes(buf, end - n, end)
        o = np.argsort(h, kind="stable")
        self.hashes, self.number, self.size, self.at, self.bytes = h[o], o, n[o], (end - n)[o], buf

    def find(self, buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Term number of every token [a, b) of the buffer, -1 for others."""
        out = np.full(len(a), -1, np.int64)
        if not len(self.hashes) or not len(a):
            return out
        h = word_hashes(buf, a, b)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = np.flatnonzero((self.hashes[at] == h) & (self.size[at] == b - a))
        if not len(hit):
            return out
        slot = at[hit]
        n = self.size[slot]
        start = np.cumsum(n) - n
        within = np.arange(int(n.sum())) - np.repeat(start, n)
        same = buf[np.repeat(a[hit], n) + within] == self.bytes[np.repeat(self.at[slot], n) + within]
        same = np.logical_and.reduceat(same, start)
        out[hit[same]] = self.number[slot[same]]
        return out


# ------------------------------------------------------------------ postings

def _postings(terms: list[bytes]):
    """Documents -> one row a shard with its postings in term order (see BLOCK)."""
    def run(batches):
        words = Dictionary(terms)
        part = TaskContext.get().partitionId()
        run_no = 0
        ids, lens, docs, found, tfs = [], [], [], [], []
        n_docs = n_terms = held = kept = 0

        def flush():
            nonlocal run_no, ids, lens, docs, found, tfs, n_docs, n_terms, held, kept
            t = np.concatenate(found) if found else np.zeros(0, np.int64)
            o = np.argsort(t, kind="stable")
            t, d = t[o], (np.concatenate(docs) if docs else t)[o]
            own, first = np.unique(t, return_index=True)
            row = [[(part << 32) + run_no], [n_docs], [n_terms]]
            raw = [np.concatenate(ids) if ids else t, np.concatenate(lens) if lens else t, own.astype(np.int32),
                   np.append(first, len(t)), d.astype(np.int32), (np.concatenate(tfs) if tfs else t)[o].astype(np.int32)]
            batch = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in row]
                                               + [pa.array([x.tobytes()], pa.binary()) for x in raw],
                                               [c.split()[0] for c in BLOCK.split(", ")])
            run_no += 1
            ids, lens, docs, found, tfs = [], [], [], [], []
            n_docs = n_terms = held = kept = 0
            return batch

        for batch in batches:
            doc_id = batch.column("doc_id")
            for i, starts, buf in text_chunks(batch.column("text")):
                low = BYTE_MAP[buf]
                a, b, first = word_spans(low, starts)
                n = np.diff(first)
                t = words.find(low, a, b)
                hit = np.flatnonzero(t >= 0)
                owner = np.searchsorted(first, hit, "right") - 1
                key, tf = np.unique(owner * len(terms) + t[hit], return_counts=True)
                who, place = np.unique(key // max(1, len(terms)), return_inverse=True)
                mine = doc_id.slice(i, len(n)).take(pa.array(who))
                ids.append(np.where(mine.is_null().to_numpy(zero_copy_only=False), 0,
                                    mine.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64))
                # a document without an id keeps its postings for the statistics: length -1 marks it
                lens.append(np.where(mine.is_null().to_numpy(zero_copy_only=False), -1, n[who]))
                docs.append(place + kept)
                found.append(key % max(1, len(terms)))
                tfs.append(tf)
                n_docs += int((n > 0).sum())
                n_terms += int(n.sum())
                kept += len(who)
                held += len(key)
                if kept >= SHARD_DOCS or held >= SHARD_POSTINGS:
                    yield flush()
        if n_docs:
            yield flush()
    return run


def _frequencies(batches):
    """(term, df) of every shard."""
    for batch in batches:
        for term, offs in zip(batch.column("term"), batch.column("offs")):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(term.as_py(), np.int32)), pa.array(np.diff(np.frombuffer(offs.as_py(), np.int64)))],
                ["term", "df"])


def statistics(blocks: DataFrame, n_terms: int):
    """N, L and the document frequency of every term of the block's dictionary (bounded)."""
    n_docs, total = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    rows = (blocks.select("term", "offs").mapInArrow(_frequencies, "term int, df bigint")
            .groupBy("term").agg(F.sum("df").alias("df")).collect())
    df = np.zeros(n_terms, np.int64)
    for r in rows:
        df[r["term"]] = r["df"]
    return n_docs, total, df


def _owned(stage: int, owner: np.ndarray, w: np.ndarray, n_docs: int, total: int, bundles: list):
    """Postings of one owner for every bundle: terms, borders, documents and contributions, and per item
    what the terms of later owners can still add in the shard."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                term, offs = np.frombuffer(r["term"], np.int32), np.frombuffer(r["offs"], np.int64)
                doc, tf = np.frombuffer(r["doc"], np.int32), np.frombuffer(r["tf"], np.int32).astype(np.int64)
                lens = np.frombuffer(r["lens"], np.int64)
                n = np.diff(offs)
                of = np.repeat(np.arange(len(term)), n)
                ok = lens[doc] >= 0
                c = contribution(w[term][of], tf, length_measure(np.maximum(lens[doc], 0), n_docs, total))
                c = np.where(ok, c, 0)
                most = np.maximum.reduceat(c, offs[:-1]) if len(term) else c
                now = np.flatnonzero(owner[term] == stage)
                later = np.zeros(len(w), np.int64)
                later[term] = np.where(owner[term] > stage, most, 0)
                for b, (starts, item_terms) in enumerate(bundles):
                    rest = np.add.reduceat(later[item_terms], starts[:-1])
                    mine = now[np.isin(term[now], item_terms)]
                    take = np.concatenate([np.arange(offs[x], offs[x + 1]) for x in mine]) if len(mine) else np.zeros(0, np.int64)
                    take = take[ok[take] & (c[take] > 0)]
                    per = np.bincount(of[take], minlength=len(term))[mine]
                    raw = [term[mine], np.append(0, np.cumsum(per)), doc[take], c[take], rest,
                           np.frombuffer(r["docs"], np.int64) if stage == STAGES - 1 else np.zeros(0, np.int64)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b], pa.int32()), pa.array([r["shard"]], pa.int64())]
                        + [pa.array([x.tobytes()], pa.binary()) for x in raw],
                        ["bundle", "shard", "term", "offs", "doc", "add", "rest", "ids"])
    return run


OWNED = "bundle int, shard bigint, term binary, offs binary, doc binary, add binary, rest binary, ids binary"


def _added(bundles: list, travellers: pd.DataFrame, postings: pd.DataFrame):
    """Accumulators (items x documents) of one traveller after one stage."""
    t = travellers.iloc[0]
    starts, item_terms = bundles[int(t["bundle"])]
    acc = np.zeros((len(starts) - 1, int(t["n_docs"])), np.int64)
    acc[np.frombuffer(t["item"], np.int32), np.frombuffer(t["doc"], np.int32)] = np.frombuffer(t["score"], np.int64)
    rest = np.zeros(len(acc), np.int64)
    ids = None
    if len(postings):
        p = postings.iloc[0]
        term, offs = np.frombuffer(p["term"], np.int32), np.frombuffer(p["offs"], np.int64)
        doc, add = np.frombuffer(p["doc"], np.int32), np.frombuffer(p["add"], np.int64)
        rest, ids = np.frombuffer(p["rest"], np.int64), np.frombuffer(p["ids"], np.int64)
        item_of = np.repeat(np.arange(len(acc)), np.diff(starts))
        o = np.argsort(item_terms, kind="stable")
        lo, hi = np.searchsorted(item_terms[o], term), np.searchsorted(item_terms[o], term, "right")
        for x in range(len(term)):
            own = slice(offs[x], offs[x + 1])
            acc[np.ix_(item_of[o[lo[x]:hi[x]]], doc[own])] += add[own]
    return t, acc, rest, ids


def _kept(acc: np.ndarray, rest: np.ndarray, k: int):
    """Accumulators that can still be among the best ``k`` of their item."""
    floor = np.zeros(len(acc), np.int64)
    if acc.shape[1] >= k:
        floor = np.partition(acc, acc.shape[1] - k, axis=1)[:, acc.shape[1] - k]
    return np.nonzero((acc > 0) & (acc + rest[:, None] >= floor[:, None]))


def _stage(left: pd.DataFrame, right: pd.DataFrame, bundles: list, k: int) -> pd.DataFrame:
    """One term owner: adds its contributions to a traveller's accumulators."""
    names = [c.split()[0] for c in TRAVELLER.split(", ")]
    if not len(left):
        return pd.DataFrame(columns=names)
    t, acc, rest, _ = _added(bundles, left, right)
    item, doc = _kept(acc, rest, k)
    return pd.DataFrame([(t["bundle"], t["shard"], t["n_docs"], item.astype(np.int32).tobytes(), doc.astype(np.int32).tobytes(),
                          acc[item, doc].tobytes())], columns=names)


def _last(left: pd.DataFrame, right: pd.DataFrame, bundles: list, names: list, k: int) -> pd.DataFrame:
    """The last owner: adds, then selects the best documents of every item in the shard."""
    empty = pd.DataFrame({"item_id": np.zeros(0, np.int64), "doc_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
    if not len(left) or not len(right):
        return empty
    t, acc, rest, ids = _added(bundles, left, right)
    item, doc = _kept(acc, rest, k)
    score = acc[item, doc]
    o = np.lexsort((ids[doc], -score, item))
    item, doc, score = item[o], doc[o], score[o]
    best = np.arange(len(item)) - np.searchsorted(item, item) < k
    return pd.DataFrame({"item_id": names[int(t["bundle"])][item[best]], "doc_id": ids[doc[best]], "score": score[best]})


# ------------------------------------------------------------------ search

def _search_block(docs: DataFrame, items: list, k: int) -> DataFrame:
    """Best documents of every item of one block: item_id, doc_id, score (``k`` a shard).

    items: (item_id, distinct terms), together at most one block."""
    terms = sorted({t for _, own in items for t in own})
    number = {t: i for i, t in enumerate(terms)}
    blocks = staged(docs.mapInArrow(_postings(terms), BLOCK), "postings")
    n_docs, total, df = statistics(blocks, len(terms))
    w = np.array([weight(n_docs, int(x)) if x else 0 for x in df], np.int64)
    # owners: the rarest terms first, equal shares of all postings
    order = np.lexsort((np.arange(len(df)), df))
    owner = np.empty(len(df), np.int64)
    cum = np.cumsum(df[order])
    owner[order] = np.minimum(STAGES * (cum - df[order]) // max(1, int(cum[-1])), STAGES - 1)
    bundles, names = [], []
    for lo in range(0, len(items), BUNDLE_ITEMS):
        some = items[lo:lo + BUNDLE_ITEMS]
        starts = np.append(0, np.cumsum([len(own) for _, own in some]))
        bundles.append((starts, np.array([number[t] for _, own in some for t in own], np.int64)))
        names.append(np.array([i for i, _ in some], np.int64))
    none = F.lit(b"").cast("binary")
    kept = (F.length("lens") / 8).cast("int")       # documents that hold a term of the block
    travel = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(len(bundles) - 1))).alias("bundle"), "shard",
                           kept.alias("n_docs"), none.alias("item"), none.alias("doc"), none.alias("score"))
    out = None
    for s in range(STAGES):
        owned = blocks.drop("n_docs", "n_terms").mapInArrow(_owned(s, owner, w, n_docs, total, bundles), OWNED)
        pair = travel.groupBy("bundle", "shard").cogroup(owned.groupBy("bundle", "shard"))
        if s < STAGES - 1:
            travel = pair.applyInPandas(lambda x, y: _stage(x, y, bundles, k), TRAVELLER)
        else:
            out = pair.applyInPandas(lambda x, y: _last(x, y, bundles, names, k), "item_id bigint, doc_id bigint, score bigint")
    return out


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, terms (distinct, of all rows of the id) of the items that have any."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    one = items.filter("item_id is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term"))
    return one.groupBy("item_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of every item.

    docs: doc_id, text; items: item_id, text."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = staged(item_terms(items), "items")
    n_terms = own.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    out = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    n_blocks = -(-n_terms // BLOCK_TERMS)
    for b in range(n_blocks):
        rows = own.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == b).collect()     # bounded: see BLOCK_TERMS
        some = sorted((r["item_id"], [t.encode() for t in r["terms"]]) for r in rows)
        if some:
            out = out.unionByName(_search_block(d, some, k))
    win = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (out.withColumn("rank", F.row_number().over(win)).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
