"""Repeated super-windows over a whole corpus: the part that substring dedup by
De Bruijn paths and by suffix arrays have in common.

Pass 1 counts anchors (combined before the shuffle); pass 2 keeps the super-windows
whose anchor occurs at least twice.  Super-windows of equal content are one class;
all but its earliest occurrence consist of repeated windows.  What remains open are the
earliest occurrences of classes that share an anchor with another class: only there
can a window be repeated inside different surroundings.

Coordinates are (doc_id, start); a null doc_id comes before all others.  Rows that
share a doc_id lie at the same coordinates, told apart by a hash of the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import release, staged, text_chunks, word_hashes, word_spans
from panelspark.llm.supers import anchors, super_windows

NULL_ID = -(1 << 63)


def keyed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Rows with id (null replaced), th (hash of the text), text, and ``keep`` columns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
                       F.xxhash64(text).alias("th"), text.alias("text"), *[F.col(c).alias(f"k_{c}") for c in keep])


def sequences(buf: np.ndarray, starts: np.ndarray, unit: str):
    """Values and starts of the sequences of a chunk: words or bytes."""
    if unit == "byte":
        return buf.astype(np.uint64), starts
    a, b, first = word_spans(buf, starts)
    return word_hashes(buf, a, b), first


def _anchors(unit: str, window: int, k: int):
    def run(batches):
        for batch in batches:
            for _, starts, buf in text_chunks(batch.column("text")):
                u, c = np.unique(anchors(*sequences(buf, starts, unit), window, k), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.astype(np.int64)), pa.array(c.astype(np.int64))], ["m", "c"])
    return run


def _supers(unit: str, window: int, k: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            th = batch.column("th").to_numpy(zero_copy_only=False)
            for i, starts, buf in text_chunks(batch.column("text")):
                seq, lo, hi, m, h = super_windows(*sequences(buf, starts, unit), window, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m.astype(np.int64)), pa.array(h.astype(np.int64)), pa.array(ids[i + seq]), pa.array(th[i + seq]),
                     pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], ["m", "h", "id", "th", "lo", "hi"])
    return run


def classify(docs: DataFrame, unit: str, window: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(repeated, open): repeated has (id, th, lo, hi), ranges of window starts that
    repeat an earlier place; open has (m, id, th, lo, hi, classes), earliest
    occurrences whose anchor has several classes."""
    thin = docs.select("id", "th", "text")
    again = (thin.select("text").mapInArrow(_anchors(unit, window, k), "m bigint, c bigint")
             .groupBy("m").agg(F.sum("c").alias("c")).filter("c > 1").select("m"))
    again = staged(again, "anchors")        # written, so that the join below has plain exchanges it can split
    hits = thin.mapInArrow(_supers(unit, window, k), "m bigint, h bigint, id bigint, th bigint, lo int, hi int")
    hits = staged(hits.join(again, "m", "left_semi"), "hits")
    release(docs.sparkSession)
    first = staged(hits.groupBy("m", "h").agg(F.min(F.struct("id", "lo", "th", "hi")).alias("f")), "first")
    repeated = (hits.join(first.select("m", "h", F.col("f.id").alias("fid"), F.col("f.lo").alias("flo")), ["m", "h"])
                .filter((F.col("id") != F.col("fid")) | (F.col("lo") != F.col("flo"))).select("id", "th", "lo", "hi"))
    several = first.groupBy("m").agg(F.count("*").alias("classes")).filter("classes > 1")
    still = first.join(several, "m").select("m", "f.id", "f.th", "f.lo", "f.hi", "classes")
    return staged(repeated, "repeated"), staged(still, "open")


def per_document(ranges: DataFrame, *columns: str) -> DataFrame:
    """One row per document: id, th, spans (array of the given columns)."""
    return ranges.groupBy("id", "th").agg(F.collect_list(F.struct(*columns)).alias("spans"))


def covered(spans: list, n: int, window: int) -> np.ndarray:
    """Which of ``n`` units lie in a window that starts in one of the ranges."""
    edge = np.zeros(n + 1, np.int64)
    if spans:
        lo = np.array([s["lo"] for s in spans])
        hi = np.array([s["hi"] for s in spans])
        np.add.at(edge, lo, 1)
        np.add.at(edge, hi + window, -1)
    return np.cumsum(edge[:n]) > 0
