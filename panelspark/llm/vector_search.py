"""Exact top-k inner-product search by columnar branch and bound.

Vectors are kept in vertical layout (one array per dimension) in blocks of rows.
A query block meets a row block by adding the inner products one group of
dimensions at a time.  After each group, what the remaining dimensions can
still add is bounded by the product of the remaining lengths of query and row
(Cauchy-Schwarz); rows whose bound lies below the ``k``-th best score of every
query in the block are dropped and the surviving columns are compacted.

Every query block meets every row block of every shard; a task holds one query
block and the few row blocks of one shard, and keeps ``k`` rows a query.

Defined cases: vectors that are null or hold null or non-finite components
take no part; a vector of fewer dimensions counts as padded with zeros; ties go
to the smaller id; a row never meets rows with its own id (repeated rows of one
id included); with fewer than ``k`` other rows all are returned; a query id
that occurs repeatedly is answered once, from its smallest vector (compared by
component); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import staged

TOP = 20
SCALE = 64
BLOCK_ROWS = 4096           # rows packed in a row block
BLOCK_QUERIES = 512         # queries packed in a query block
SHARD_BLOCKS = 8            # row blocks a task holds
GROUP_DIMS = 16             # dimensions added between two bounds


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v: array of floor(scale * x) of the vectors that take part."""
    ok = (F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()
          & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return vectors.filter(ok).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"))


def _block(ids: list, mats: list) -> pa.RecordBatch:
    """One block: its ids and its matrix (dims x rows) in the narrowest integers."""
    dims = max(len(m) for m in mats)
    m = np.hstack([_pad(x, dims) for x in mats])
    top = int(np.abs(m).max(initial=0))
    kind = np.int16 if top < 2 ** 15 else np.int32 if top < 2 ** 31 else np.int64
    return pa.RecordBatch.from_arrays(
        [pa.array([np.concatenate(ids).tobytes()], pa.binary()), pa.array([m.astype(kind).tobytes()], pa.binary()),
         pa.array([dims], pa.int32()), pa.array([m.shape[1]], pa.int32())], ["ids", "block", "dims", "n"])


def _pack(batches):
    """Rows (vec_id, v) of a partition -> blocks of about BLOCK_ROWS rows."""
    ids: list = []
    mats: list = []
    held = 0
    for batch in batches:
        lists = batch.column("v")
        n = np.diff(lists.offsets.to_numpy())
        if not len(n):
            continue
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        m = np.zeros((int(n.max()), len(n)), np.int64)
        m[np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n), np.repeat(np.arange(len(n)), n)] = flat
        ids.append(batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64))
        mats.append(m)
        held += len(n)
        if held >= BLOCK_ROWS:
            yield _block(ids, mats)
            ids, mats, held = [], [], 0
    if ids:
        yield _block(ids, mats)


def _pack_group(group: pa.Table) -> pa.Table:
    blocks = list(_pack(group.select(["vec_id", "v"]).combine_chunks().to_batches()))
    t = pa.Table.from_batches(blocks)
    return t.append_column("qblock", pa.array([group["qblock"][0].as_py()] * len(t), pa.int32()))


def _unpack(r) -> tuple[np.ndarray, np.ndarray]:
    size = len(r.block) // max(1, r.dims * r.n)
    kind = {2: np.int16, 4: np.int32, 8: np.int64}.get(size, np.int64)
    return np.frombuffer(r.ids, np.int64), np.frombuffer(r.block, kind).reshape(r.dims, r.n)


def _pad(block: np.ndarray, dims: int) -> np.ndarray:
    return block if len(block) == dims else np.vstack([block, np.zeros((dims - len(block), block.shape[1]), block.dtype)])


def search_block(qids: np.ndarray, q: np.ndarray, blocks: list, k: int = TOP):
    """Best ``k`` rows of every query over the row blocks, exact.

    q: dims x queries; blocks: (ids, dims x rows).  Returns (query index, row
    id, score) arrays, at most ``k`` a query."""
    none = np.iinfo(np.int64).min
    best_s = np.full((len(qids), k), none)
    best_i = np.full((len(qids), k), np.iinfo(np.int64).max)
    for ids, rows in blocks:
        dims = max(len(q), len(rows))
        a, b = _pad(q, dims), _pad(rows, dims)
        # sums below 2**53 are exact in doubles, larger ones stay integers
        exact = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * dims < 2 ** 52
        a, b = (a.astype(np.float64), b.astype(np.float64)) if exact else (a.astype(np.int64), b.astype(np.int64))
        # length that the dimensions from every border on still have
        rest_a = np.sqrt(np.vstack([np.cumsum((a.astype(float) ** 2)[::-1], 0)[::-1], np.zeros((1, a.shape[1]))]))
        rest_b = np.sqrt(np.vstack([np.cumsum((b.astype(float) ** 2)[::-1], 0)[::-1], np.zeros((1, b.shape[1]))]))
        alive = np.arange(b.shape[1])
        score = np.zeros((a.shape[1], b.shape[1]), a.dtype)
        low = best_s[:, -1]
        for lo in range(0, dims, GROUP_DIMS):
            hi = min(dims, lo + GROUP_DIMS)
            part = b[lo:hi] if len(alive) == b.shape[1] else b[lo:hi][:, alive]
            score += a[lo:hi].T @ part
            if hi < dims and (low > none).all():
                # a margin above the rounding of the roots keeps the bound safe
                bound = np.outer(rest_a[hi], rest_b[hi][alive] * (1 + 1e-9)) + 1e-6
                bound += score
                keep = (bound >= low[:, None]).any(0)
                if not keep.all():
                    alive, score = alive[keep], score[:, keep]
        if not len(alive):
            continue
        rid = ids[alive]
        s = score.astype(np.int64)
        s[rid[None, :] == qids[:, None]] = none
        cut = low
        if s.shape[1] > 2 * k:
            # only rows at or above the k-th value of the block can enter
            cut = np.maximum(np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k], low)
        qi, ci = np.nonzero((s >= cut[:, None]) & (s > none))
        if not len(qi):
            continue
        all_q = np.concatenate([qi, np.repeat(np.arange(len(qids)), k)])
        all_s = np.concatenate([s[qi, ci], best_s.ravel()])
        all_i = np.concatenate([rid[ci], best_i.ravel()])
        o = np.lexsort((all_i, -1 - all_s, all_q))              # -1 - s reverses without overflow
        all_q, all_s, all_i = all_q[o], all_s[o], all_i[o]
        nth = np.arange(len(all_q)) - np.searchsorted(all_q, all_q)
        keep = nth < k
        best_s[all_q[keep], nth[keep]] = all_s[keep]
        best_i[all_q[keep], nth[keep]] = all_i[keep]
    qi, ci = np.nonzero(best_s > none)
    return qi, best_i[qi, ci], best_s[qi, ci]


def _search(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks = [_unpack(r) for r in pdf[~pdf["is_query"]].itertuples()]
        out = []
        for r in pdf[pdf["is_query"]].itertuples():
            qids, qm = _unpack(r)
            qi, ids, s = search_block(qids, qm, blocks, k)
            out.append(pd.DataFrame({"query_id": qids[qi], "vec_id": ids, "score": s}))
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})
    return run


def top_k(queries: DataFrame, rows: DataFrame, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best rows of every query.

    queries, rows: vec_id, v (arrays of integers).  Rows are packed in the
    partitions they are read in, queries in hash groups; the grid of query
    blocks and shards is an equi-join on generated numbers, replicated per
    block and not per row."""
    packed = "ids binary, block binary, dims int, n int"
    one = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    groups = max(1, -(-queries.count() // BLOCK_QUERIES))
    qb = staged(one.withColumn("qblock", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
                .groupBy("qblock").applyInArrow(_pack_group, packed + ", qblock int"), "queries")
    rb = staged(rows.mapInArrow(_pack, packed), "rows")
    shards = max(1, -(-rb.count() // SHARD_BLOCKS))
    shard = F.pmod(F.xxhash64("ids", "block"), F.lit(shards)).cast("int")
    grid_q = qb.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("is_query", F.lit(True))
    grid_r = (rb.withColumn("shard", shard).withColumn("is_query", F.lit(False))
              .withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    part = (grid_q.unionByName(grid_r).groupBy("qblock", "shard")
            .applyInPandas(_search(k), "query_id bigint, vec_id bigint, score bigint"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (part.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
