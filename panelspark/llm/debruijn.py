"""Substring dedup of word windows by De Bruijn compaction.

Every window of ``WINDOW`` words is an edge between the nodes of its first and
its last ``WINDOW - 1`` words.  Windows that lie in equal super-windows are settled
by ``repeats.classify``; the others (around the ends of repeated passages and around
edits) form the graph.  A node is a junction if two different edges enter or
leave it, or if some document's stretch of edges begins or ends there.  Between
junctions the paths do not branch: every occurrence is cut at the same nodes, so
a path is named by its first edge and its length and needs no chasing of
pointers.  The paths' occurrences carry source coordinates: an occurrence is
removed if the same path, checked by a second hash of its first edge and its
length, lies at an earlier coordinate.

Defined cases: null and empty texts have no words and keep nothing; texts shorter
than a window keep all words; rows that share a doc_id lie at the same
coordinates, so an identical repeated row is treated as the row it repeats;
a null doc_id comes before all others; very long texts are taken whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import release, staged, text_chunks, word_hashes, word_spans
from panelspark.llm.repeats import classify, covered, keyed, per_document
from panelspark.llm.supers import window_hashes

WINDOW = 20                 # fixed value: words
GRAM = 8                    # words of an anchor

_EDGE = ["e", "e2", "left", "right", "id", "th", "at", "end", "starts"]
_EDGE_SCHEMA = ("e bigint, e2 bigint, left bigint, right bigint, id bigint, th bigint, at int, end int, starts boolean")


def _edges(batches):
    """Edges of the open windows of a document: hashes of edge and nodes, start,
    last start of its stretch, and whether it begins a stretch."""
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        th = batch.column("th").to_numpy(zero_copy_only=False)
        spans = batch.column("spans").to_pylist()
        for i, starts, buf in text_chunks(batch.column("text")):
            a, b, first = word_spans(buf, starts)
            h = word_hashes(buf, a, b)
            parts: list = []
            for j in range(len(starts) - 1):
                own = h[first[j]:first[j + 1]]
                if len(own) < WINDOW:
                    continue
                open_ = covered([{"lo": s["lo"], "hi": s["hi"]} for s in spans[i + j]], len(own) - WINDOW + 1, 1)
                at = np.flatnonzero(open_)
                if not len(at):
                    continue
                begins = np.concatenate([[True], np.diff(at) > 1])
                stretch = np.cumsum(begins) - 1
                end = np.append(at[np.flatnonzero(begins)[1:] - 1], at[-1])[stretch]
                e, e2 = window_hashes(own, WINDOW)
                node = window_hashes(own, WINDOW - 1)[0]
                parts.append((e[at].astype(np.int64), e2[at].astype(np.int64), node[at].astype(np.int64),
                              node[at + 1].astype(np.int64), np.full(len(at), ids[i + j]), np.full(len(at), th[i + j]),
                              at.astype(np.int32), end.astype(np.int32), begins))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], _EDGE)


def repeated_paths(docs: DataFrame, open_: DataFrame) -> DataFrame:
    """(id, th, lo, hi) of the window starts on repeated paths of the open windows."""
    own = docs.select("id", "th", "text").join(per_document(open_, "lo", "hi"), ["id", "th"])
    edges = staged(own.mapInArrow(_edges, _EDGE_SCHEMA), "edges")
    release(docs.sparkSession)
    none = F.lit(None).cast("bigint")
    sides = (edges.select(F.col("left").alias("node"), F.col("e").alias("out"), none.alias("into"), F.col("starts").alias("cut"))
             .unionByName(edges.select(F.col("right").alias("node"), none.alias("out"), F.col("e").alias("into"),
                                       (F.col("at") == F.col("end")).alias("cut"))))
    nodes = sides.groupBy("node").agg(F.min("out").alias("o1"), F.max("out").alias("o2"), F.min("into").alias("i1"),
                                      F.max("into").alias("i2"), F.max("cut").alias("cut"))
    junctions = staged(nodes.filter("cut or o1 <> o2 or i1 <> i2").select(F.col("node").alias("left")), "junctions")
    cuts = edges.select("e", "e2", "left", "id", "th", "at", "end").join(junctions, "left", "left_semi")
    # a path runs to the next cut of its stretch
    after = F.lead("at").over(Window.partitionBy("id", "th", "end").orderBy("at"))
    paths = cuts.distinct().withColumn("hi", F.coalesce(after - 1, F.col("end"))).withColumn("length", F.col("hi") - F.col("at"))
    paths = staged(paths.select("e", "e2", "length", "id", "th", "at", "hi"), "paths")
    source = paths.groupBy("e", "e2", "length").agg(F.min(F.struct("id", "at")).alias("s"), F.count("*").alias("n"))
    source = staged(source.filter("n > 1").select("e", "e2", "length", F.col("s.id").alias("sid"), F.col("s.at").alias("sat")), "sources")
    return (paths.join(source, ["e", "e2", "length"]).filter((F.col("id") != F.col("sid")) | (F.col("at") != F.col("sat")))
            .select("id", "th", F.col("at").alias("lo"), "hi"))


def _keep_words(with_text: bool):
    def run(batches):
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            total, gone, digest, text = [], [], [], []
            for i, starts, buf in text_chunks(batch.column("text")):
                raw = buf.tobytes()
                for j in range(len(starts) - 1):
                    words = raw[starts[j]:starts[j + 1]].split()
                    n = len(words)
                    out = covered(spans[i + j], n, WINDOW) if spans[i + j] else None
                    if out is not None:
                        words = [w for w, x in zip(words, out) if not x]
                    kept = b" ".join(words)
                    total.append(n)
                    gone.append(n - len(words))
                    if with_text:
                        whole = raw[starts[j]:starts[j + 1]] if out is None else kept
                        text.append(whole.decode("utf-8", "replace"))
                    else:
                        digest.append(hashlib.sha256(kept).hexdigest())
            names = [c for c in batch.schema.names if c.startswith("k_")]
            cols = [batch.column(c) for c in names] + [pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
            last = pa.array(text, pa.string()) if with_text else pa.array(digest, pa.string())
            yield pa.RecordBatch.from_arrays(cols + [last], names + ["n_words", "n_removed", "kept"])
    return run


def dedup_words(docs: DataFrame, keep: list[str], with_text: bool = False) -> DataFrame:
    """``keep`` columns, n_words, n_removed and kept: the hash of the kept words,
    or with ``with_text`` what is left of the text (kept words joined by one
    space; the text itself where nothing is removed, empty for null)."""
    d = keyed(docs, keep)
    repeated, open_ = classify(d, "word", WINDOW, GRAM)
    ranges = repeated.unionByName(repeated_paths(d, open_))
    spans = staged(per_document(ranges, "lo", "hi"), "spans")
    release(docs.sparkSession)
    types = ", ".join(f"`k_{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    out = (d.join(spans, ["id", "th"], "left").select("text", "spans", *[f"k_{c}" for c in keep])
           .mapInArrow(_keep_words(with_text), f"{types}, n_words bigint, n_removed bigint, kept string"))
    return out.select(*[F.col(f"k_{c}").alias(c) for c in keep], "n_words", "n_removed", "kept")
