"""Approximate nearest neighbours by multi-index hashing.

Nearness is the inner product.  Rows are shifted by the sample's mean (which moves all
inner products of a query by one constant) and get one more component that
brings them all to the greatest length M, so that the angle between the query and a row orders
the rows as the inner product does.

*Codes.*  On a bounded sample, rotations are learned by iterative quantisation; the
signs of the rotated components are a row's binary code of ``BITS`` bits.
*Index.*  A code is split into substrings of ``SUBSTRING`` bits; every block of rows holds, per
substring, its rows in the order of the substring's value.
*Probing.*  To find all codes within Hamming radius r, the substrings get thresholds that sum
to r - m + 1 (m substrings): by the pigeonhole principle a code within r is within the threshold in at least one
substring.  The buckets within a substring's threshold are enumerated by masks of few bits, or, when the
block occupies fewer buckets than there are masks, among the occupied ones.  Rows found are checked
on their full code, and those within r are scored on the original vectors in double precision.
*Radius.*  Every query has its own: a score that its ``k``-th best row very likely reaches (at first from the ranks of the
sample, see ``safe_rank``; then from the rows found) says at which angle a better row must lie, and the sample's near pairs say
how far codes of the ``k`` nearest are apart at most (in binomial deviations, calibrated to all but ``MISS`` of the pairs).  Small radii are probed first, and the radius
still to be reached shrinks as better rows are found, so
queries with close neighbours probe few buckets, and it is the whole code as long as fewer than ``k`` rows are known.

All rows are indexed; the sample (``SAMPLE`` rows by hash, ``SAMPLE_BYTES`` at most) only fits rotations and spread.

A task holds one block of queries and one shard of rows and returns at most ``k`` rows a query, only
such as reach that first score; the sample's own best rows join at the end.

Defined cases: vectors that are null, zero or hold null or non-finite components take no part; shorter
vectors count as padded with zeros; ties go to the smaller id; a row never meets rows with its own id;
rows that share an id are one candidate, scored by the best of them; an id that occurs repeatedly among the queries is asked once,
with its smallest vector; with fewer than ``k`` other rows all are returned; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import staged

TOP = 20
BITS = 128
SUBSTRING = 16
SAMPLE = 4096               # rows that rotations and spread are fitted on
SAMPLE_BYTES = 32 << 20
ITERATIONS = 20             # rounds of iterative quantisation
MISS = 0.05                 # share of the sample's near pairs beyond the calibrated distance
SURE = 0.95
PROBE_COST = 32             # looking a bucket up costs as much as comparing so many occupied ones
BLOCK_ROWS = 8192           # rows of one index block (and of a task)
BLOCK_QUERIES = 4096        # queries of a task
ROUNDS = (0.125, 0.25)   # shares of the code that are probed before a query's full radius
CHUNK = 64                  # queries compared at once inside a task
SEEDS = "seeds array<struct<query_id:bigint,vec_id:bigint,score:double>>"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of double) of the vectors that take part."""
    ok = (F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()
          & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
          & F.exists("embedding", lambda x: x != 0))
    return vectors.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"),
                                     F.transform("embedding", lambda x: x.cast("double")).alias("v"))


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list array, padded with zeros."""
    n = np.diff(lists.offsets.to_numpy())
    m = np.zeros((len(n), dims))
    m[np.repeat(np.arange(len(n)), n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)] = (
        lists.flatten().to_numpy(zero_copy_only=False))
    return m


# ------------------------------------------------------------------ model

def learn_rotations(x: np.ndarray, bits: int = BITS, seed: int = 1) -> np.ndarray:
    """(components, bits): blocks of orthonormal columns, each turned by iterative
    quantisation so that the rotated sample lies close to its own signs."""
    rng = np.random.default_rng(seed)
    d, out, left = x.shape[1], [], bits
    while left:
        width = min(d, left)
        r = np.linalg.qr(rng.normal(size=(d, d)))[0][:, :width]
        for _ in range(ITERATIONS):
            u, _, vt = np.linalg.svd(x.T @ np.where(x @ r >= 0, 1.0, -1.0), full_matrices=False)
            r = u @ vt
        out.append(r)
        left -= width
    return np.hstack(out)


def pack_bits(signs: np.ndarray) -> np.ndarray:
    """Codes (rows, bits) -> (rows, substrings) of 16-bit numbers."""
    return np.packbits(signs, axis=1).view(">u2").astype(np.uint16)


class Codes:
    """Learned codes: mean, length M, rotations and the calibrated spread."""

    def __init__(self, mean: np.ndarray, top: float, rotations: np.ndarray, spread: float):
        self.mean, self.top, self.rotations, self.spread = mean, top, rotations, spread
        self.bits = rotations.shape[1]

    def rows(self, v: np.ndarray) -> np.ndarray:
        x = v - self.mean
        rest = np.sqrt(np.maximum(self.top ** 2 - (x * x).sum(1), 0.0))
        return pack_bits(x @ self.rotations[:-1] + rest[:, None] * self.rotations[-1] >= 0)

    def queries(self, q: np.ndarray) -> np.ndarray:
        return pack_bits(q @ self.rotations[:-1] >= 0)

    def angle(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Angle over pi at which a row of that score lies."""
        length = np.sqrt((q * q).sum(1)) * self.top
        return np.arccos(np.clip((score - q @ self.mean) / np.maximum(length, 1e-300), -1, 1)) / np.pi

    def radius(self, q: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Hamming radius that holds the rows scoring ``low`` or more (-inf: all)."""
        p = self.angle(q, np.where(np.isfinite(low), low, 0.0))
        r = np.ceil(self.bits * p + self.spread * np.sqrt(self.bits * p * (1 - p)) + 1)
        return np.where(np.isfinite(low), np.minimum(r, self.bits), self.bits).astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of paired codes (as 16-bit numbers)."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def fit_codes(sample: np.ndarray, top: float, mean: np.ndarray, k: int = TOP, bits: int = BITS) -> Codes:
    x = sample - mean
    x = np.hstack([x, np.sqrt(np.maximum(top ** 2 - (x * x).sum(1), 0.0))[:, None]])
    codes = Codes(mean, top, learn_rotations(x, bits), 0.0)
    q = sample[:256]                        # near pairs: the k nearest of the first rows
    s = q @ sample.T
    s[np.arange(len(q)), np.arange(len(q))] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        codes.spread = np.inf
        return codes
    near = np.argpartition(-s, k - 1, axis=1)[:, :k]
    qi = np.repeat(np.arange(len(q)), k)
    # how far the codes of the k nearest lie beyond the expected distance of the k-th, in its deviations
    p = codes.angle(q, np.take_along_axis(s, near, 1).min(1))[qi]
    h = distances(codes.queries(q)[qi], codes.rows(sample)[near.ravel()])
    z = (h - codes.bits * p) / np.sqrt(np.maximum(codes.bits * p * (1 - p), 1.0))
    codes.spread = max(0.0, float(np.quantile(z, 1 - MISS)))
    return codes


def safe_rank(k: int, share: float) -> int:
    """Rank in a sample of that share of the rows whose score the k-th best of all rows very likely reaches: the
    number of the k best rows that fall into the sample is at most this with probability ``SURE`` (Poisson)."""
    mean, j = k * share, 0
    term = total = math.exp(-mean)
    while total < SURE and j < k:
        j += 1
        term *= mean / j
        total += term
    return max(1, min(k, j + 1)) if share < 1 else k


# ------------------------------------------------------------------ index and search

def masks_within(width: int, t: int) -> np.ndarray:
    """All bit masks of at most ``t`` set bits."""
    out = [0]
    for c in range(1, t + 1):
        out += [sum(1 << i for i in some) for some in itertools.combinations(range(width), c)]
    return np.array(out, np.uint16)


_MASKS: dict = {}


class Index:
    """Rows of a block by substring value: for each substring, the occupied values and the
    rows in value order."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.words = codes, np.ascontiguousarray(np.ascontiguousarray(codes).view(np.uint64).T)
        self.columns = np.ascontiguousarray(codes.T)
        self.parts = []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            values, bucket_of = np.unique(codes[:, j], return_inverse=True)
            size = np.bincount(bucket_of, minlength=len(values))
            self.parts.append((order, values, np.append(0, np.cumsum(size)), bucket_of))

    def within(self, code: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, distance) of every code within the query's radius."""
        m = self.codes.shape[1]
        found = np.zeros((len(code), len(self.codes)), bool)
        # thresholds that sum to radius - m + 1; a substring of threshold -1 is not probed
        base, more = np.divmod(radius - m + 1, m)
        for j, (order, values, first, bucket_of) in enumerate(self.parts):
            t = np.minimum(base + (j < more), SUBSTRING)
            for limit in np.unique(t[t >= 0]).tolist():
                who = np.flatnonzero(t == limit)
                if PROBE_COST * sum(math.comb(SUBSTRING, c) for c in range(limit + 1)) < len(values):
                    if limit not in _MASKS:
                        _MASKS[limit] = masks_within(SUBSTRING, limit)
                    probe = code[who, j][:, None] ^ _MASKS[limit][None, :]
                    at = np.minimum(np.searchsorted(values, probe), len(values) - 1)
                    qi, bi = np.nonzero(values[at] == probe)
                    bucket = at[qi, bi]
                    n = first[bucket + 1] - first[bucket]
                    pos = np.repeat(first[bucket], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    found[np.repeat(who[qi], n), order[pos]] = True
                elif 2 * len(values) < len(self.codes):
                    near = np.bitwise_count(code[who, j][:, None] ^ values[None, :]) <= limit
                    found[who] |= np.take(near, bucket_of, axis=1)
                else:                       # most buckets hold one row
                    found[who] |= np.bitwise_count(code[who, j][:, None] ^ self.columns[j][None, :]) <= limit
        # full codes of what was found
        far = np.zeros(found.shape, np.uint16)
        own = code.view(np.uint64)
        for w, rows in enumerate(self.words):
            far += np.bitwise_count(own[:, w][:, None] ^ rows[None, :])
        qi, ri = np.nonzero(found & (far <= radius[:, None]))
        return qi, ri, far[qi, ri].astype(np.int64)


def inner(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows with one vector; the same sum for the same pair wherever it is computed."""
    return np.einsum("ij,j->i", rows, q)


def best_of(qi, ids, score, k: int):
    """Best ``k`` distinct ids of every query: (query, id, score), sorted."""
    o = np.lexsort((ids, -score, qi))
    qi, ids, score = qi[o], ids[o], score[o]
    o = np.lexsort((np.arange(len(qi)), ids, qi))           # an id's best row first
    again = np.zeros(len(qi), bool)
    again[o[1:]] = (qi[o[1:]] == qi[o[:-1]]) & (ids[o[1:]] == ids[o[:-1]])
    qi, ids, score = qi[~again], ids[~again], score[~again]
    keep = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return qi[keep], ids[keep], score[keep]


def kth(qi, score, n: int, k: int) -> np.ndarray:
    """k-th best score of every query, -inf with fewer."""
    out = np.full(n, -np.inf)
    nth = np.arange(len(qi)) - np.searchsorted(qi, qi)
    at = nth == k - 1
    out[qi[at]] = score[at]
    return out


def seeds(qids, q, ids, rows, k: int = TOP):
    """Best ``k`` rows of the sample for every query: (query, id, score)."""
    out = []
    for lo in range(0, len(q), CHUNK):
        s = q[lo:lo + CHUNK] @ rows.T
        s[qids[lo:lo + CHUNK][:, None] == ids[None, :]] = -np.inf
        kk = min(4 * k, s.shape[1])
        near = np.argpartition(-s, kk - 1, axis=1)[:, :kk]
        qi = np.repeat(np.arange(len(s)), kk)
        score = np.concatenate([inner(rows[n], v) for n, v in zip(near, q[lo:lo + CHUNK])])
        ok = ids[near.ravel()] != qids[lo + qi]
        a, b, c = best_of(qi[ok], ids[near.ravel()][ok], score[ok], k)
        out.append((a + lo, b, c))
    return [np.concatenate(x) for x in zip(*out)]


def search_block(codes: Codes, qids, q, low, ids, rows, row_codes, k: int = TOP, stats: dict | None = None):
    """Best rows of a block for every query, among those scoring ``low`` or more."""
    index = Index(row_codes)
    out = []
    for at in range(0, len(q), CHUNK):
        some, own, floor = q[at:at + CHUNK], qids[at:at + CHUNK], low[at:at + CHUNK].copy()
        code = codes.queries(some)
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        done = np.full(len(some), -1)
        for step in (*ROUNDS, 1.0):
            # rows found so far raise the k-th score and so shrink the radius still to be probed
            radius = np.minimum(int(step * codes.bits), codes.radius(some, floor))
            live = np.flatnonzero(radius > done)
            if not len(live):
                continue
            qi, ri, far = index.within(code[live], radius[live])
            new = far > done[live][qi]
            qi, ri = live[qi[new]], ri[new]
            done = np.maximum(done, radius)
            if stats is not None:
                stats["scored"] = stats.get("scored", 0) + len(qi)
            at_q = np.searchsorted(qi, np.arange(len(some) + 1))
            score = np.concatenate([inner(rows[ri[a:b]], v) for a, b, v in zip(at_q[:-1], at_q[1:], some)])
            ok = (ids[ri] != own[qi]) & (score >= floor[qi])
            found = best_of(*[np.concatenate(x) for x in zip(found, (qi[ok], ids[ri][ok], score[ok]))], k)
            floor = np.maximum(floor, kth(found[0], found[2], len(some), k))
        if stats is not None:
            stats["all"] = stats.get("all", 0) + len(some) * len(ids)
        out.append((found[0] + at, found[1], found[2]))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


# ------------------------------------------------------------------ Spark side

def _pack(codes: Codes, dims: int):
    """Rows (vec_id, v) -> blocks: ids, vectors, codes."""
    def run(batches):
        part, nth = TaskContext.get().partitionId(), 0
        ids, mats, held = [], [], 0

        def block(ids, mats):
            m = np.vstack(mats)
            return pa.RecordBatch.from_arrays(
                [pa.array([np.concatenate(ids).tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary()),
                 pa.array([codes.rows(m).tobytes()], pa.binary()), pa.array([part], pa.int64()), pa.array([nth], pa.int64())],
                ["ids", "block", "codes", "part", "nth"])
        for batch in batches:
            if not batch.num_rows:
                continue
            ids.append(batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64))
            mats.append(matrix(batch.column("v"), dims))
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                yield block(ids, mats)
                ids, mats, held, nth = [], [], 0, nth + 1
        if held:
            yield block(ids, mats)
    return run


def _pack_queries(sample_ids: np.ndarray, sample: np.ndarray, dims: int, k: int, rank: int):
    def run(group: pa.Table) -> pa.Table:
        ids = group["vec_id"].to_numpy().astype(np.int64)
        q = matrix(group["v"].combine_chunks(), dims)
        qi, vec, score = seeds(ids, q, sample_ids, sample, k)
        first = pa.StructArray.from_arrays([pa.array(ids[qi]), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])
        return pa.table({"ids": pa.array([ids.tobytes()], pa.binary()), "block": pa.array([q.tobytes()], pa.binary()),
                         "codes": pa.array([kth(qi, score, len(q), rank).tobytes()], pa.binary()),
                         "qblock": pa.array([group["qblock"][0].as_py()], pa.int32()),
                         "seeds": pa.ListArray.from_arrays(pa.array([0, len(first)], pa.int32()), first)})
    return run


def _search(codes: Codes, dims: int, k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in pdf[pdf["is_query"]].itertuples():
            qids, q = np.frombuffer(r.ids, np.int64), np.frombuffer(r.block).reshape(-1, dims)
            low = np.frombuffer(r.codes).copy()
            found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            for b in pdf[~pdf["is_query"]].itertuples():
                got = search_block(codes, qids, q, low, np.frombuffer(b.ids, np.int64), np.frombuffer(b.block).reshape(-1, dims),
                                   np.frombuffer(b.codes, np.uint16).reshape(-1, codes.bits // SUBSTRING), k)
                found = best_of(*[np.concatenate(x) for x in zip(found, got)], k)
                low = np.maximum(low, kth(found[0], found[2], len(q), k))
            out.append(pd.DataFrame({"query_id": qids[found[0]], "vec_id": found[1], "score": found[2]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64),
                                                        "score": np.zeros(0)})
    return run


def learn(rows: DataFrame, k: int = TOP, bits: int = BITS):
    """(codes, dims, sample ids, sample, number of rows) for ``rows``, or None for an empty table.

    One aggregate for the components, one bounded sample, one aggregate for the
    greatest length of all rows."""
    dims, count = rows.agg(F.max(F.size("v")), F.count("*")).first()
    if not dims:
        return None
    n = max(2, min(SAMPLE, SAMPLE_BYTES // (8 * dims)))
    got = rows.orderBy(F.xxhash64(F.lit(7), "vec_id"), "vec_id", "v").limit(n).toArrow()
    ids = got["vec_id"].to_numpy().astype(np.int64)
    sample = matrix(got["v"].combine_chunks(), dims)
    mean = sample.mean(0)
    shift = F.array(*[F.lit(float(x)) for x in mean])
    gap = F.zip_with("v", shift, lambda a, b: F.coalesce(a, F.lit(0.0)) - b)
    far = rows.select(F.aggregate(gap, F.lit(0.0), lambda acc, x: acc + x * x).alias("far")).agg(F.max("far")).first()[0]
    return fit_codes(sample, float(np.sqrt(far)) * (1 + 1e-12), mean, k, bits), dims, ids, sample, count


def nearest(queries: DataFrame, rows: DataFrame, k: int = TOP, bits: int = BITS) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest rows found for every query.

    queries, rows: vec_id, v.  Rows are packed in the partitions they are read in,
    queries in hash groups; the grid of query blocks and shards is an equi-join on
    generated numbers, replicated per block and not per row."""
    spark = rows.sparkSession
    model = learn(rows, k, bits)
    if model is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    codes, dims, ids, sample, count = model
    packed = "ids binary, block binary, codes binary"
    one = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    groups = max(1, -(-queries.count() // BLOCK_QUERIES))
    qb = staged(one.withColumn("qblock", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
                .groupBy("qblock").applyInArrow(_pack_queries(ids, sample, dims, k, safe_rank(k, len(ids) / count)), packed + ", qblock int, " + SEEDS), "nn-queries")
    rb = staged(rows.mapInArrow(_pack(codes, dims), packed + ", part bigint, nth bigint"), "nn-rows")
    shards, parts = rb.agg(F.count("*"), F.max("part") + 1).first()
    # blocks of all partitions in turn, so that shards hold about one block each
    shard = F.pmod(F.col("nth") * F.lit(parts) + F.col("part"), F.lit(shards)).cast("int")
    known = qb.select(F.inline("seeds"))
    grid_q = qb.drop("seeds").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("is_query", F.lit(True))
    grid_r = (rb.withColumn("shard", shard).drop("part", "nth").withColumn("is_query", F.lit(False))
              .withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    found = (grid_q.unionByName(grid_r).groupBy("qblock", "shard")
             .applyInPandas(_search(codes, dims, k), "query_id bigint, vec_id bigint, score double"))
    found = found.unionByName(known).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
