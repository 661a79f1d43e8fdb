"""Exact k-nearest-neighbour join and KNN regression.

Two exact strategies, chosen by a size check on the reference side:

* **broadcast** - the reference fits one block of ``max_block_bytes``: it is
  broadcast once and each query partition scores its rows against it with
  numpy, keeping only the k best per query;
* **pivots** - otherwise nothing passes through the driver but a bounded sample of
  reference rows, the pivots.  Every reference row belongs to the cell of its nearest
  pivot; a cell is known by its size and radius (greatest distance to the pivot).  A
  query first visits its own cell.  The distance of its k-th neighbour there, or a bound from sizes and radii,
  is an upper limit ``tau`` for the k-th neighbour overall, and by the triangle inequality a cell whose pivot is farther than
  ``tau`` plus its radius (or farther than the own pivot by more than ``2 tau``) can hold none: the query visits the other cells only.
  Inside a cell, rows lie in order of their distance to the pivot, and only the ring ``tau`` around the query's own distance is scored.
  This holds for every Minkowski order from 1 on.  Neighbouring cells are packed into shards of ``SHARD_BYTES``
  (a larger cell is dealt over several), a query travels once to every shard that holds a cell it must visit,
  many queries of one shard are dealt into blocks of their own, and every pair of query block and shard
  meets once in an ``applyInPandas`` co-group, so no cell is hot.  There the cells are scored in blocks of ``max_block_bytes``
  against all queries that must visit them, and only rows within a query's limit become candidates; the limit falls as they are found.

Either way a task emits k rows per query, never all pairs, and the winners of the visited
shards are reduced to the final k with a window per query.  Ties are broken by
reference id: the result is exact and deterministic.  ``probe`` turns the second strategy
into the approximate join: a query visits its ``probe`` nearest cells and no others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import cut_lineage

DEFAULT_BLOCK_BYTES = 128 * 1024 * 1024
_CHUNK_ELEMS = 4_000_000


def _matrix(pdf: pd.DataFrame, features) -> np.ndarray:
    if isinstance(features, str):
        return np.vstack([np.asarray(v, dtype=float) for v in pdf[features]]) if len(pdf) else np.zeros((0, 0))
    return pdf[list(features)].to_numpy(dtype=float)


def _minkowski(Q: np.ndarray, R: np.ndarray, p: int) -> np.ndarray:
    diff = np.abs(Q[:, None, :] - R[None, :, :])
    if p == 1:
        return diff.sum(axis=2)
    if p == 2:
        return np.sqrt((diff * diff).sum(axis=2))
    return (diff ** p).sum(axis=2) ** (1.0 / p)


def _topk_euclid(Q, q_ids, R, r_ids, k, exclude_self, rn):
    """Euclidean top-k of each row of ``Q``: (selected columns, distances) sorted by
    (distance, id), or None for rows with no finite candidate.

    A matrix product screens the candidates (squared distance = |q|^2 + |r|^2
    - 2 q.r); every reference row whose screened value lies within a margin of
    the k-th screened value is re-scored with the exact difference formula.
    The margin (1e-9 of the squared norms) is far above the rounding error of
    the product, so the candidate set holds every true neighbour and all ties
    at the k-th distance: the result equals brute force exactly.
    """
    qn = np.einsum("ij,ij->i", Q, Q)
    D2 = qn[:, None] + rn[None, :] - 2.0 * (Q @ R.T)
    if exclude_self:
        D2[q_ids[:, None] == r_ids[None, :]] = np.inf
    kk = min(k, D2.shape[1])
    kth = np.partition(D2, kk - 1, axis=1)[:, kk - 1]
    margin = 1e-9 * (qn + rn.max()) + 1e-300
    ri, ci = np.nonzero((D2 <= (kth + margin)[:, None]) & np.isfinite(D2))
    diff = Q[ri] - R[ci]
    dist = np.sqrt((diff * diff).sum(axis=1))
    order = np.lexsort((r_ids[ci], dist, ri))
    ri, ci, dist = ri[order], ci[order], dist[order]
    starts = np.searchsorted(ri, ri, side="left")
    keep = (np.arange(len(ri)) - starts) < kk
    return ri[keep], ci[keep], dist[keep]


def _topk(pdf, R, r_ids, r_carry, qid, rid, features, carry, k, p, exclude_self):
    """k best reference rows per query row of ``pdf`` (numpy, chunked)."""
    if len(pdf) == 0 or len(r_ids) == 0:
        return None
    Q = _matrix(pdf, features)
    q_ids = pdf[qid].to_numpy(dtype=np.int64)
    if p == 2:
        rn = np.einsum("ij,ij->i", R, R)
        step = max(1, _CHUNK_ELEMS // max(1, R.shape[0]))
        rows = []
        for s in range(0, len(Q), step):
            qi, ci, dist = _topk_euclid(Q[s:s + step], q_ids[s:s + step], R, r_ids, k, exclude_self, rn)
            frame = {qid: q_ids[s:s + step][qi], rid: r_ids[ci], "distance": dist}
            for c in carry:
                frame[c] = r_carry[c][ci]
            rows.append(pd.DataFrame(frame))
        return pd.concat(rows, ignore_index=True) if rows else None
    step = max(1, _CHUNK_ELEMS // max(1, R.shape[0] * max(1, R.shape[1])))
    rows = []
    for s in range(0, len(Q), step):
        D = _minkowski(Q[s:s + step], R, p)
        if exclude_self:
            D = np.where(q_ids[s:s + step, None] == r_ids[None, :], np.inf, D)
        kk = min(k, D.shape[1])
        m = D.shape[0]
        sel = np.argpartition(D, kk - 1, axis=1)[:, :kk] if kk < D.shape[1] else \
            np.tile(np.arange(D.shape[1]), (m, 1))
        dsel = np.take_along_axis(D, sel, axis=1)
        kth = dsel.max(axis=1)
        ties = (D <= kth[:, None]).sum(axis=1) > kk
        for i in np.nonzero(ties)[0]:      # rare: resolve boundary ties by id
            cand = np.nonzero(D[i] <= kth[i])[0]
            sel[i] = cand[np.lexsort((r_ids[cand], D[i, cand]))[:kk]]
        dsel = np.take_along_axis(D, sel, axis=1)
        order = np.lexsort((r_ids[sel], dsel), axis=1)
        sel = np.take_along_axis(sel, order, axis=1)
        dsel = np.take_along_axis(dsel, order, axis=1)
        ok = np.isfinite(dsel)
        frame = {qid: np.repeat(q_ids[s:s + step], kk)[ok.ravel()], rid: r_ids[sel][ok], "distance": dsel[ok]}
        for c in carry:
            frame[c] = r_carry[c][sel][ok]
        rows.append(pd.DataFrame(frame))
    return pd.concat(rows, ignore_index=True) if rows else None


def knn_join(queries: DataFrame, ref: DataFrame, qid: str, rid: str, features, k: int = 5, p: int = 2,
             exclude_self: bool = False, carry: Sequence[str] = (),
             max_block_bytes: int = DEFAULT_BLOCK_BYTES, probe: int | None = None, stats: dict | None = None) -> DataFrame:
    """(qid, rid, distance, rank [, carry...]) for the k nearest reference rows.

    ``features``: list of numeric columns, or the name of one array column.
    ``exclude_self``: drop pairs with equal ids (leave-one-out on one table).
    ``carry``: reference columns returned with each neighbour (e.g. a label).
    ``probe``: approximate form, cells visited per query (by pivots, whatever the size).
    ``stats``: filled with the pairs in visited cells and all pairs (costs an aggregate; pivots only).
    """
    spark = queries.sparkSession
    fcols = [features] if isinstance(features, str) else list(features)
    dim = 1 if isinstance(features, str) else len(fcols)
    if isinstance(features, str):
        n_ref, dim = ref.agg(F.count(F.lit(1)), F.max(F.size(features))).first()
        dim = int(dim or 1)
    else:
        n_ref = ref.count()
    row_bytes = 8 * (dim + 2 + len(carry))
    n_blocks = max(1, math.ceil(n_ref * row_bytes / max_block_bytes))
    out_schema = f"{qid} long, {rid} long, distance double" + "".join(f", `{c}` double" for c in carry)
    if n_ref and (probe is not None or n_blocks > 1):
        u = _by_pivots(queries, ref, qid, rid, fcols, features, carry, k, p, exclude_self, n_ref, dim,
                       max(16, max_block_bytes // row_bytes), out_schema, probe, stats)
    else:
        block = ref.select(rid, *fcols, *carry).toPandas()      # one block, size checked above
        R = _matrix(block, features)
        r_ids = block[rid].to_numpy(dtype=np.int64)
        r_carry = {c: block[c].to_numpy(dtype=float) for c in carry}
        bc = spark.sparkContext.broadcast((R, r_ids, r_carry))

        def score(it, bc=bc):
            R, r_ids, r_carry = bc.value
            for pdf in it:
                out = _topk(pdf, R, r_ids, r_carry, qid, rid, features, carry, k, p, exclude_self)
                if out is not None:
                    yield out
        u = queries.select(F.col(qid).cast("long").alias(qid), *fcols).mapInPandas(score, out_schema)
    w = Window.partitionBy(qid).orderBy("distance", rid)
    return u.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


MAX_PIVOTS = 1024
PIVOT_BYTES = 16 * 1024 * 1024
SLACK = 1e-6                # bounds give way by this share of the lengths, far above rounding


def _distances(X: np.ndarray, P: np.ndarray, p: int) -> np.ndarray:
    """Distances of rows to pivots, to within ``SLACK`` of the lengths."""
    if p == 2:
        sq = np.einsum("ij,ij->i", X, X)[:, None] + np.einsum("ij,ij->i", P, P)[None, :] - 2.0 * (X @ P.T)
        return np.sqrt(np.maximum(sq, 0.0))
    step = max(1, _CHUNK_ELEMS // max(1, P.size))
    return np.vstack([_minkowski(X[s:s + step], P, p) for s in range(0, len(X), step)]) if len(X) else np.zeros((0, len(P)))


def _slack(X: np.ndarray, P: np.ndarray) -> float:
    return SLACK * float(np.abs(X).max(initial=0.0) + np.abs(P).max(initial=0.0)) * X.shape[1] + 1e-300


def _pivots(ref: DataFrame, rid: str, fcols, features, n_ref: int, dim: int) -> np.ndarray:
    """About sqrt(n) different reference rows by hash of their id, at most ``MAX_PIVOTS`` and ``PIVOT_BYTES``."""
    m = int(min(MAX_PIVOTS, max(1, PIVOT_BYTES // (8 * dim)), max(1, math.isqrt(n_ref))))
    rows = ref.select(rid, *fcols).orderBy(F.xxhash64(F.lit(3), F.col(rid)), rid).limit(m).toPandas()
    return np.unique(_matrix(rows, features), axis=0)


def _upper_limit(D: np.ndarray, size: np.ndarray, radius: np.ndarray, k: int) -> np.ndarray:
    """Upper limit of the k-th distance: the cells with the smallest farthest point that hold k rows."""
    far = D + radius[None, :]
    order = np.argsort(far, axis=1)
    enough = np.cumsum(size[order], axis=1) >= k
    first = np.argmax(enough, axis=1)
    at = far[np.arange(len(D)), order[np.arange(len(D)), first]]
    return np.where(enough.any(axis=1), at, np.inf)


def _shards(P: np.ndarray, size: np.ndarray, shard_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of shards of every cell: cells along the pivots' widest direction are packed
    up to ``shard_rows`` rows, a larger cell has shards of its own."""
    centred = P - P.mean(axis=0) if len(P) else P
    along = centred @ np.linalg.svd(centred, full_matrices=False)[2][0] if len(P) > 1 else np.zeros(len(P))
    first, parts = np.zeros(len(P), np.int64), np.maximum(1, -(-size // shard_rows))
    shard, held = -1, shard_rows
    for c in np.argsort(along, kind="stable"):
        if held + size[c] > shard_rows:
            shard, held = shard + 1, 0
        first[c] = shard
        if parts[c] > 1:
            shard, held = shard + parts[c] - 1, shard_rows
        else:
            held += size[c]
    return first, parts


def _candidates(Q, q_ids, R, r_ids, limit: np.ndarray, k: int, p: int, exclude_self: bool):
    """(query, row, distance) of all pairs within the query's limit that can be among its k nearest,
    distances by the exact difference formula."""
    if p != 2:
        D = _minkowski(Q, R, p)
        qi, ri = np.nonzero(D <= limit[:, None])
        dist = D[qi, ri]
    else:
        qn, rn = np.einsum("ij,ij->i", Q, Q), np.einsum("ij,ij->i", R, R)
        D2 = Q @ R.T
        D2 *= -2.0
        D2 += qn[:, None]
        D2 += rn[None, :]
        # the margin is far above the rounding error of the product (see ``_topk_euclid``)
        margin = 1e-9 * (qn + rn.max(initial=0.0)) + 1e-300
        near = D2 <= (limit * limit * (1 + 1e-9) + margin)[:, None]
        if k < D2.shape[1] and np.count_nonzero(near) > 4 * k * len(Q):         # a loose limit: the block's own k-th
            if exclude_self:
                D2[q_ids[:, None] == r_ids[None, :]] = np.inf
            near &= D2 <= (np.partition(D2, k - 1, axis=1)[:, k - 1] + margin)[:, None]
        qi, ri = np.nonzero(near)
        dist = np.empty(len(qi))
        step = max(1, _CHUNK_ELEMS // max(1, Q.shape[1]))
        for a in range(0, len(qi), step):
            diff = Q[qi[a:a + step]] - R[ri[a:a + step]]
            dist[a:a + step] = np.sqrt((diff * diff).sum(axis=1))
    keep = (dist <= limit[qi]) & np.isfinite(dist)
    if exclude_self:
        keep &= q_ids[qi] != r_ids[ri]
    return qi[keep], ri[keep], dist[keep]


class _Best:
    """The k nearest rows of every query so far, by (distance, id), and the distance that a further one may not exceed."""

    def __init__(self, limit: np.ndarray, k: int):
        self.k, self.limit = k, limit.copy()
        self.distance = np.full((len(limit), k), np.inf)
        self.ids = np.zeros((len(limit), k), np.int64)
        self.row = np.full((len(limit), k), -1)

    def take(self, q: np.ndarray, distance: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        last = self.distance[q, -1]
        new = (distance < last) | ((distance == last) & (ids < self.ids[q, -1]))
        q, distance, ids, row = q[new], distance[new], ids[new], row[new]
        if not len(q):
            return
        which = np.unique(q)
        old = np.repeat(which, self.k)
        q, distance = np.concatenate([old, q]), np.concatenate([self.distance[which].ravel(), distance])
        ids, row = np.concatenate([self.ids[which].ravel(), ids]), np.concatenate([self.row[which].ravel(), row])
        order = np.lexsort((ids, distance, q))
        nth = np.arange(len(q)) - np.searchsorted(q[order], which).repeat(np.unique(q, return_counts=True)[1])
        order = order[nth < self.k]
        for kept, v in ((self.distance, distance), (self.ids, ids), (self.row, row)):
            kept[which] = v[order].reshape(len(which), self.k)
        self.limit[which] = np.minimum(self.limit[which], self.distance[which, -1])


SHARD_BYTES = 16 * 1024 * 1024
STEP = 2048                 # queries whose distances to all pivots a task holds at a time


def _by_pivots(queries, ref, qid, rid, fcols, features, carry, k, p, exclude_self, n_ref, dim, block_rows, out_schema, probe, stats):
    P = _pivots(ref, rid, fcols, features, n_ref, dim)
    types = dict(ref.select(*fcols).dtypes)
    spec = ", ".join(f"`{c}` {types[c]}" for c in fcols)

    def steps(it):
        for pdf in it:
            for a in range(0, len(pdf), STEP):
                part = pdf.iloc[a:a + STEP]
                X = _matrix(part, features)
                yield part, X, _distances(X, P, p)

    def assign(it):
        for pdf, X, D in steps(it):
            own = D.argmin(axis=1)
            yield pdf.assign(__cell=own.astype(np.int32), __at=D[np.arange(len(D)), own])
    rows = ref.select(F.col(rid).cast("long").alias(rid), *fcols, *[F.col(c).cast("double").alias(c) for c in carry])
    rows = cut_lineage(rows.mapInPandas(assign, f"`{rid}` long, {spec}" + "".join(f", `{c}` double" for c in carry) + ", __cell int, __at double"))
    size, radius = np.zeros(len(P), np.int64), np.full(len(P), -np.inf)
    for r in rows.groupBy("__cell").agg(F.count(F.lit(1)).alias("n"), F.max("__at").alias("r")).collect():       # one row a pivot
        size[r["__cell"]], radius[r["__cell"]] = r["n"], r["r"]
    shard_rows = max(block_rows, SHARD_BYTES // (8 * (dim + 2 + len(carry))))
    first, parts = _shards(P, size, shard_rows)
    # rows that share the query's id are no neighbours
    need = k + (int(rows.groupBy(rid).count().agg(F.max("count")).first()[0] or 0) if exclude_self else 0)
    first_visits = probe or 1

    def spread(pdf, qi, ci, tau):
        """A row per query and shard of a cell to visit; ``__one``: no other cell is visited there."""
        n = parts[ci]
        at = np.repeat(np.arange(len(qi)), n)
        part = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        return pdf.iloc[qi[at]].assign(__cell=ci[at].astype(np.int32), __tau=tau[at], __shard=(first[ci][at] + part).astype(np.int32),
                                       __one=True, __pairs=np.where(part == 0, size[ci][at], 0))

    def open_visits(it):
        """The query's nearest cells and a first limit."""
        for pdf, X, D in steps(it):
            D = np.where(size[None, :] > 0, D, np.inf)
            tau = _upper_limit(D, size, radius, need) + _slack(X, P)
            n = min(first_visits, int((size > 0).sum()))
            near = np.argsort(D, axis=1, kind="stable")[:, :n].ravel()
            at = np.repeat(np.arange(len(X)), n)
            yield spread(pdf, at, near, np.full(len(at), np.inf) if probe else tau[at])

    def may_hold(D, own, tau, slack):
        """Cells other than the one visited first that can hold a row within the limit."""
        bound = np.maximum(D - radius[None, :], (D - D[np.arange(len(D)), own][:, None]) / 2)
        may = (bound <= tau[:, None] + slack) & (size[None, :] > 0)
        may[np.arange(len(D)), own] = False
        return may

    def other_visits(it):
        """The shards of all those cells, each once."""
        n_shards = int((first + parts).max(initial=1))
        for pdf, X, D in steps(it):
            own, tau = pdf["__cell"].to_numpy(), pdf["__tau"].to_numpy(dtype=float)
            slack = _slack(X, P)
            may = may_hold(D, own, tau, slack)
            pairs = np.zeros((len(X), n_shards), np.int64)
            to = np.zeros((len(X), n_shards), bool)
            for c in np.flatnonzero(may.any(axis=0)):
                to[:, first[c]:first[c] + parts[c]] |= may[:, c:c + 1]
                pairs[:, first[c]] += np.where(may[:, c], size[c], 0)
            qi, si = np.nonzero(to)
            for a in range(0, len(qi), 4 * STEP):            # some MB of an Arrow batch
                q, sh = qi[a:a + 4 * STEP], si[a:a + 4 * STEP]
                yield pdf.iloc[q].assign(__shard=sh.astype(np.int32), __one=False, __tau=tau[q] + slack, __pairs=pairs[q, sh])

    visit_schema = f"`{qid}` long, {spec}, __cell int, __tau double, __shard int, __one boolean, __pairs long"

    def pair(qpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({c: pd.Series(dtype="float64" if c not in (qid, rid) else "int64") for c in [qid, rid, "distance", *carry]})
        if not len(qpdf) or not len(rpdf):
            return none
        rpdf = rpdf.sort_values(["__cell", "__at", rid], kind="stable")
        cell, ring = rpdf["__cell"].to_numpy(), rpdf["__at"].to_numpy()
        R, r_ids = _matrix(rpdf, features), rpdf[rid].to_numpy(dtype=np.int64)
        cells, begin = np.unique(cell, return_index=True)
        end = np.append(begin[1:], len(cell))
        out = [none]
        step = max(1, _CHUNK_ELEMS // len(cells))
        for a in range(0, len(qpdf), step):
            part = qpdf.iloc[a:a + step]
            q_ids, best = nearest(part, R, r_ids, ring, cells, begin, end)
            qi, nth = np.nonzero(best.row >= 0)
            at = best.row[qi, nth]
            out.append(pd.DataFrame({qid: q_ids[qi], rid: r_ids[at], "distance": best.distance[qi, nth],
                                     **{c: rpdf[c].to_numpy(dtype=float)[at] for c in carry}}))
        return pd.concat([x for x in out if len(x)] or out[:1], ignore_index=True)

    def nearest(qpdf, R, r_ids, ring, cells, begin, end):
        """The best rows of a shard, cell by cell, for a slice of its queries."""
        Q, q_ids = _matrix(qpdf, features), qpdf[qid].to_numpy(dtype=np.int64)
        own, one = qpdf["__cell"].to_numpy(), qpdf["__one"].to_numpy(dtype=bool)
        best = _Best(qpdf["__tau"].to_numpy(dtype=float), k)
        slack = _slack(Q, P) + _slack(R, P)
        # distances to the pivots here and, for the queries that visit by limit, to the own one
        D, d_own = _distances(Q, P[cells], p), np.zeros(len(Q))
        for c in np.unique(own[~one]):
            at = np.flatnonzero((own == c) & ~one)
            d_own[at] = _distances(Q[at], P[c:c + 1], p)[:, 0]
        for i in np.argsort(np.median(D, axis=0), kind="stable"):
            c = cells[i]
            bound = np.maximum(D[:, i] - radius[c], (D[:, i] - d_own) / 2)
            q = np.flatnonzero(np.where(one, own == c, (own != c) & (bound <= best.limit + slack)))
            for a in range(begin[i], end[i], block_rows):
                z = slice(a, min(a + block_rows, end[i]))
                # the block's part of the ring: only queries whose limit reaches it
                reach = best.limit[q] + slack
                asked = q[(D[q, i] + reach >= ring[a]) & (D[q, i] - reach <= ring[z.stop - 1])]
                step = max(1, _CHUNK_ELEMS // ((z.stop - a) * (1 if p == 2 else max(1, R.shape[1]))))
                for s in range(0, len(asked), step):
                    some = asked[s:s + step]
                    qi, ri, dist = _candidates(Q[some], q_ids[some], R[z], r_ids[z], best.limit[some], k, p, exclude_self)
                    best.take(some[qi], dist, r_ids[z][ri], a + ri)
        return q_ids, best

    def visited(visits: DataFrame) -> DataFrame:
        many = visits.groupBy("__shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("int").alias("__qb"))
        of = lambda v: F.element_at(F.array(*[F.lit(int(x)) for x in v]), F.col("__cell") + 1)
        # one row a shard
        q = visits.join(F.broadcast(many), "__shard").withColumn("__qblock", F.pmod(F.xxhash64(F.lit(1), qid), F.col("__qb")).cast("int")).drop("__qb")
        r = rows.withColumn("__shard", (of(first) + F.pmod(F.xxhash64(F.lit(2), rid), of(parts))).cast("int")) \
            .join(F.broadcast(many), "__shard").withColumn("__qblock", F.explode(F.sequence(F.lit(0), F.col("__qb") - 1))).drop("__qb")
        return q.groupBy("__shard", "__qblock").cogroup(r.groupBy("__shard", "__qblock")).applyInPandas(pair, out_schema)

    qs = queries.select(F.col(qid).cast("long").alias(qid), *fcols)
    visits = cut_lineage(qs.mapInPandas(open_visits, visit_schema))
    found = visited(visits)
    others = None
    if probe is None:
        found = cut_lineage(found)
        # k rows of the first cell limit the rest
        w = Window.partitionBy(qid).orderBy("distance", rid)
        kth = found.withColumn("__nth", F.row_number().over(w)).where(F.col("__nth") == k).select(qid, F.col("distance").alias("__kth"))
        limits = visits.where(F.col("__shard") == F.element_at(F.array(*[F.lit(int(x)) for x in first]), F.col("__cell") + 1)) \
            .join(kth, qid, "left").withColumn("__tau", F.least("__tau", F.coalesce("__kth", F.lit(float("inf")))))
        others = cut_lineage(limits.select(qid, *fcols, "__cell", "__tau").mapInPandas(other_visits, visit_schema))
        found = found.unionByName(visited(others))
    if stats is not None:
        both = visits if others is None else visits.unionByName(others)
        stats["pairs"] = int(both.agg(F.sum("__pairs")).first()[0] or 0)
        stats["all"] = queries.count() * n_ref
    return found


def knn_regress(queries: DataFrame, ref: DataFrame, qid: str, rid: str, features, label: str,
                k: int = 5, p: int = 2, exclude_self: bool = False, probe: int | None = None) -> DataFrame:
    """Uniform-weight KNN prediction = mean label of the k nearest."""
    nb = knn_join(queries, ref, qid, rid, features, k, p, exclude_self, carry=[label], probe=probe)
    return nb.groupBy(qid).agg(F.avg(label).alias("y_pred"), F.count(F.lit(1)).alias("n_neighbors"))
