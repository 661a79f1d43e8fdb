"""Substring dedup of byte windows with suffix arrays built by linear grouping.

Every ``WINDOW``-byte string of a text that also starts earlier is removed.
``repeats.classify`` settles the strings inside equal super-windows; what is open are
super-windows that share their anchor with different ones.  These are cut at the
anchor into cells of ``CELL`` bytes to both sides, and tasks build the generalised
suffix array of their super-windows' cell sequences.  Suffixes with four (five)
equal cells in front are neighbours there; windows whose cells agree are then
compared in the bytes that reach into the next cells.  So a suffix array of
about ten symbols stands for a super-window of up to 168 bytes.

The suffix array is built by grouping (``suffix_order``): groups of suffixes, first by
symbol, are processed from the highest to the lowest; the previous smaller
positions of a group's members are split off above their group by how often they
are hit, until each group holds the suffixes with one Lyndon prefix; one scan then
emits the order inside the groups, without renaming or recursion.

Anchors with more than ``HOT`` classes (a very common line in many surroundings) are
not put in one task.  Their super-windows are cut into pieces by where the anchor lies in a window
(ranges of 17 places, five pieces at most), and a piece's key are the bytes that all windows of its range share.  Pieces of
equal content meet in an aggregate, combined before the shuffle: all but the earliest repeat it.  Keys that still hold
more than ``HOT`` different pieces are cut again, by ever smaller ranges; at the last, a piece is one window and its key all of it.
The suffix arrays settle all keys that are not crowded.

Defined cases: null and empty texts have no bytes; texts shorter than a window are
kept whole; overlapping repeats count; matches never cross rows; rows that
share a doc_id lie at the same coordinates, so an identical repeated row is
treated as the row it repeats; a null doc_id comes before all others; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import mix64, release, staged
from panelspark.llm.repeats import classify, covered, keyed, per_document
from panelspark.llm.supers import MULT1, MULT2, Prefix

WINDOW = 100                # fixed value: bytes
GRAM = 32                   # bytes of an anchor
CELL = 17                   # (WINDOW - GRAM) / 4: four cells fill a window beside its anchor
HOT = 1024                  # pieces of a key settled in one task; a crowded key is split further
WIDTHS = (17, 9, 5, 3, 2, 1)    # places of the anchor in a piece, level by level
TASK_ROWS = 2048            # super-windows a task reads


def suffix_order(s: list[int]) -> list[int]:
    """Suffix array of ``s``, whose last symbol must be its unique smallest.

    Groups are segments of ``order``; ``group[i]`` is the start of the segment that
    holds suffix ``i``, so larger numbers are higher groups."""
    n = len(s)
    order = sorted(range(n), key=s.__getitem__)
    where = [0] * n                                  # place of a suffix in order
    group = [0] * n
    start = 0
    for at, i in enumerate(order):
        if s[i] != s[order[start]]:
            start = at
        group[i] = start
        where[i] = at
    size = [0] * n
    for g in group:
        size[g] += 1
    prev = [-1] * n
    end = n
    while end:
        g = group[order[end - 1]]
        members = order[g:end]
        if len(members) > 1:
            members.sort()
        hits: dict = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= g:          # members before i have their pointer already
                p = prev[p]
            prev[i] = p
            if p >= 0:
                hits[p] = hits.get(p, 0) + 1
        end = g
        if not hits:
            continue
        # the most often hit are split off first and end up highest
        if len(hits) == 1:
            layers = [list(hits)]
        else:
            by: dict = {}
            for p, c in hits.items():
                by.setdefault(c, []).append(p)
            layers = [by[c] for c in sorted(by, reverse=True)]
        for layer in layers:
            parts: dict = {}
            for p in layer:
                parts.setdefault(group[p], []).append(p)
            for old, moved in parts.items():
                total = size[old]
                if len(moved) == total:
                    continue                         # the whole group: nothing lies below it
                last = old + total
                for p in moved:                      # swap to the upper end of the segment
                    last -= 1
                    a, q = where[p], order[last]
                    order[a], order[last] = q, p
                    where[q], where[p] = a, last
                new = last
                size[old] = total - len(moved)
                size[new] = len(moved)
                for p in moved:
                    group[p] = new
    # emission: a suffix found in order brings the ones before it to the front of their groups
    free = list(range(n))
    out = [-1] * n
    placed = [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    free[group[n - 1]] += 1
    for at in range(n):
        i = out[at] - 1
        while i >= 0 and not placed[i]:
            g = group[i]
            out[free[g]] = i
            free[g] += 1
            placed[i] = True
            i = prev[i]
    return out


def _anchored(raw: np.ndarray, off: np.ndarray, m: np.ndarray):
    """Place of the anchor in every super-window: the right-most gram equal to ``m``
    in its first window."""
    g = mix64(Prefix(raw.astype(np.uint64), MULT1).grams(GRAM))
    reach = WINDOW - GRAM + 1
    idx = off[:-1, None] + np.arange(reach)[None, :]
    same = g[np.minimum(idx, len(g) - 1)] == m[:, None]
    return reach - 1 - np.argmax(same[:, ::-1], axis=1)


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of a task's open super-windows: (id, th, lo, hi)."""
    pieces = pdf["bytes"].tolist()
    lo = pdf["lo"].to_numpy(np.int64)
    span = pdf["hi"].to_numpy(np.int64) - lo
    ids, th, m = pdf["id"].to_numpy(np.int64), pdf["th"].to_numpy(np.int64), pdf["m"].to_numpy(np.int64).astype(np.uint64)
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(x) for x in pieces])]).astype(np.int64)
    anchor = _anchored(raw, off, m)
    values = raw.astype(np.uint64) + np.uint64(1)
    p1, p2 = Prefix(values, MULT1), Prefix(mix64(values), MULT2)
    # cells: whole ones to the left and right of the anchor, the anchor itself between
    left = anchor // CELL
    right = (np.diff(off) - anchor - GRAM) // CELL
    count = left + right + 2                                    # and a closing symbol
    first = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(pieces)), count)
    nth = np.arange(int(first[-1])) - first[owner]
    k = nth - left[owner]                                       # 0: the anchor, 1..: right cells, last: closing
    begin = (off[owner] + anchor[owner]
             + np.where(k <= 0, k * CELL, GRAM + (k - 1) * CELL))
    closing = nth == count[owner] - 1
    length = np.where(k == 0, GRAM, CELL)
    begin = np.where(closing, 0, begin)
    cell = mix64(p1.ranges(begin, begin + np.where(closing, 0, length)) + (k == 0) * np.uint64(0x1F123BB5))
    _, sym = np.unique(np.where(closing, np.uint64(0), cell), return_inverse=True)
    sym = sym + len(pieces) + 1
    sym[closing] = np.arange(len(pieces), 0, -1)                # closing symbols: smallest, all different
    order = np.array(suffix_order(sym.tolist()))
    # classes of suffixes with equal 4 and 5 first cells
    padded = np.concatenate([sym, -np.arange(1, 6)])
    equal = np.ones(len(order) - 1, bool)
    cls = {}
    for d in range(5):
        equal = equal & (padded[order[1:] + d] == padded[order[:-1] + d])
        if d >= 3:
            c = np.empty(len(order), np.int64)
            c[order] = np.concatenate([[0], np.cumsum(~equal)])
            cls[d + 1] = c
    # windows: owner, start; o bytes lie left of the anchor
    w_owner = np.repeat(np.arange(len(pieces)), span + 1)
    w_rel = np.arange(len(w_owner)) - np.repeat(np.cumsum(span + 1) - (span + 1), span + 1)
    o = anchor[w_owner] - w_rel
    q, t = o // CELL, o % CELL
    at = first[w_owner] + left[w_owner] - q                     # the suffix that starts with the window's cells
    kind = np.where(t > 0, cls[4][at], -1 - cls[5][np.where(t > 0, 0, at)])
    s = off[w_owner] + w_rel
    core = s + t + q * CELL + GRAM + (3 - q) * CELL             # end of the cells where t > 0
    core = np.where(t > 0, core, s + WINDOW)
    a = mix64(kind.astype(np.uint64) * np.uint64(MULT1) + t.astype(np.uint64))
    key1 = mix64(a ^ mix64(p1.ranges(s, s + t)) ^ mix64(p1.ranges(core, s + WINDOW) + np.uint64(1)))
    key2 = mix64(kind.astype(np.uint64) ^ mix64(p2.ranges(s, s + t)) ^ mix64(p2.ranges(core, s + WINDOW) + np.uint64(3)))
    place = lo[w_owner] + w_rel
    srt = np.lexsort((place, ids[w_owner], key2, key1))
    k1, k2, d, pl = key1[srt], key2[srt], ids[w_owner][srt], place[srt]
    new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    rep = srt[(d != d[head]) | (pl != pl[head])]
    return _ranges(ids[w_owner][rep], th[w_owner][rep], place[rep])


def _ranges(ids: np.ndarray, th: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    """Runs of consecutive starts as (id, th, lo, hi)."""
    o = np.lexsort((at, th, ids))
    ids, th, at = ids[o], th[o], at[o]
    new = np.ones(len(at), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (th[1:] != th[:-1]) | (at[1:] > at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    return pd.DataFrame({"id": ids[first], "th": th[first], "lo": at[first].astype(np.int32), "hi": at[last].astype(np.int32)})


def _cut(batches):
    """Bytes of the open super-windows of every document."""
    for batch in batches:
        ids, th = batch.column("id").to_pylist(), batch.column("th").to_pylist()
        spans, text = batch.column("spans").to_pylist(), batch.column("text")
        out: dict = {c: [] for c in ("m", "id", "th", "lo", "hi", "bytes")}
        for i in range(batch.num_rows):
            raw = text[i].as_buffer().to_pybytes()
            for s in spans[i]:
                for c in ("m", "lo", "hi"):
                    out[c].append(s[c])
                out["id"].append(ids[i]), out["th"].append(th[i])
                out["bytes"].append(raw[s["lo"]:s["hi"] + WINDOW])
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["m"], pa.int64()), pa.array(out["id"], pa.int64()), pa.array(out["th"], pa.int64()),
             pa.array(out["lo"], pa.int32()), pa.array(out["hi"], pa.int32()), pa.array(out["bytes"], pa.binary())], list(out))


PIECE = "key bigint, m bigint, id bigint, th bigint, lo int, hi int, a int, b int, bytes binary"


def _split(width: int):
    """Pieces of a crowded key by ranges of ``width`` places of the anchor, keyed by the bytes that
    all windows of the range share."""
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out: dict = {c.split()[0]: [] for c in PIECE.split(", ")}
            if rows:
                pieces = [r["bytes"] for r in rows]
                off = np.concatenate([[0], np.cumsum([len(x) for x in pieces])]).astype(np.int64)
                m = np.array([r["m"] for r in rows], np.int64).astype(np.uint64)
                anchor = _anchored(np.frombuffer(b"".join(pieces), np.uint8), off, m)
                for r, at in zip(rows, anchor.tolist()):
                    for lo in range(r["a"], r["b"] + 1, width):
                        hi = min(lo + width - 1, r["b"])
                        # windows of the piece whose anchor has lo..hi bytes to its left
                        first, last = max(0, at - hi), min(r["hi"] - r["lo"], at - lo)
                        if first > last:
                            continue
                        shared = r["bytes"][at - lo:at - hi + WINDOW]
                        head = hashlib.blake2b(shared, digest_size=8, person=bytes([lo, hi])).digest()
                        for c, v in (("key", int.from_bytes(head, "big", signed=True)), ("m", r["m"]), ("id", r["id"]), ("th", r["th"]),
                                     ("lo", r["lo"] + first), ("hi", r["lo"] + last), ("a", lo), ("b", hi),
                                     ("bytes", r["bytes"][first:last + WINDOW])):
                            out[c].append(v)
            kinds = [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))
    return run


def _settled(pieces: DataFrame) -> DataFrame:
    tasks = max(1, pieces.count() // TASK_ROWS)
    return (pieces.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks)))
            .groupBy("task").applyInPandas(_settle, "id bigint, th bigint, lo int, hi int"))


def repeated_windows(docs: DataFrame, open_: DataFrame) -> DataFrame:
    """(id, th, lo, hi) of the repeated window starts of the open super-windows."""
    spans = per_document(open_, "m", "lo", "hi")
    cut = (docs.select("id", "th", F.col("text").cast("binary").alias("text")).join(spans, ["id", "th"])
           .mapInArrow(_cut, "m bigint, id bigint, th bigint, lo int, hi int, bytes binary"))
    names = [c.split()[0] for c in PIECE.split(", ")]
    level = staged(cut.distinct().withColumn("key", F.col("m")).withColumn("a", F.lit(0))
                   .withColumn("b", F.lit(WINDOW - GRAM)).select(*names), "cut")
    release(docs.sparkSession)
    found = []
    for width in WIDTHS:
        crowded = staged(level.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("key"), "crowded")
        if crowded.isEmpty():
            return functools.reduce(DataFrame.unionByName, [*found, _settled(level)])
        found.append(_settled(staged(level.join(crowded, "key", "left_anti"), "settled")))
        parts = staged(level.join(crowded, "key", "left_semi").select(*names).mapInArrow(_split(width), PIECE)
                       .withColumn("same", F.md5("bytes")), "parts")
        # pieces of one content repeat the earliest of them, which alone goes on
        source = staged(parts.groupBy("key", "same").agg(F.min(F.struct("id", "lo")).alias("s")), "source")
        told = staged(parts.join(source.select("key", "same", F.col("s.id").alias("sid"), F.col("s.lo").alias("slo")), ["key", "same"]), "told")
        is_source = (F.col("id") == F.col("sid")) & (F.col("lo") == F.col("slo"))
        found.append(told.filter(~is_source).select("id", "th", "lo", "hi"))
        level = told.filter(is_source).select(*names)
    # single windows that share all their bytes have met: nothing is left to compare
    return functools.reduce(DataFrame.unionByName, found)


def _keep_bytes(batches):
    for batch in batches:
        spans, text = batch.column("spans").to_pylist(), batch.column("text")
        total, gone, runs, digest = [], [], [], []
        for i in range(batch.num_rows):
            raw = text[i].as_buffer().to_pybytes()
            out = covered(spans[i], len(raw), WINDOW) if spans[i] else None
            total.append(len(raw))
            if out is None:
                gone.append(0), runs.append(0)
            else:
                gone.append(int(out.sum()))
                runs.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()))
                raw = np.frombuffer(raw, np.uint8)[~out].tobytes()
            digest.append(hashlib.sha256(raw).hexdigest())
        names = [c for c in batch.schema.names if c.startswith("k_")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names] + [pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                                pa.array(runs, pa.int64()), pa.array(digest, pa.string())],
            names + ["n_bytes", "n_removed", "n_spans", "kept_sha256"])


def dedup_bytes(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    d = keyed(docs, keep)
    repeated, open_ = classify(d, "byte", WINDOW, GRAM)
    spans = staged(per_document(repeated.unionByName(repeated_windows(d, open_)), "lo", "hi"), "spans")
    release(docs.sparkSession)
    types = ", ".join(f"`k_{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    out = (d.join(spans, ["id", "th"], "left").select(F.col("text").cast("binary").alias("text"), "spans", *[f"k_{c}" for c in keep])
           .mapInArrow(_keep_bytes, f"{types}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"))
    return out.select(*[F.col(f"k_{c}").alias(c) for c in keep], "n_bytes", "n_removed", "n_spans", "kept_sha256")
