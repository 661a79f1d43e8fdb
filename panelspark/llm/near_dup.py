"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

A document's set holds its distinct five-word shingles.  The sketch has ``BINS``
coordinates, filled in rounds: in round ``i`` every shingle is thrown into one
hashed bin with a hashed value, and a bin keeps the smallest (round, value); rounds
go on until every bin is filled, and from round ``BINS`` on each round fills one
bin with the smallest value of all shingles, so ``2 * BINS`` rounds always
suffice.  ``BANDS`` bands of ``BINS / BANDS`` coordinates give the buckets: a pair
of similarity 0.75 shares at least one with probability 1 - 5e-6.

Documents with equal sets are one class and stand as one node.  First every node
is verified against its smallest partner over all buckets (a star, never all
pairs), which joins most groups.  Buckets whose members still lie in different
components are then settled in full: their members are dealt into chunks of
``CHUNK`` and each task holds two chunks of a bucket, counts all common shingles of
their texts at once and returns only the links that join components, never
pairs.  A link counts only if the full shingle sets of the two texts meet the
threshold.  The work inside such a bucket grows with the square of its size
(spread over tasks); buckets that lie in one component cost nothing.

Defined cases: null and empty texts have no shingles and are linked with
nothing; fewer than five words form one shingle; rows that share a doc_id are
one document, linked through any of its texts; a null doc_id is linked with
nothing (component null, kept); repeated rows stay; an empty table gives an
empty result; texts are taken whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import lower_ascii, mix64, staged, text_chunks, word_hashes, word_spans
from panelspark.llm.graph import components
from panelspark.llm.supers import MULT1, Prefix

SHINGLE = 5                 # fixed values: words a shingle, similarity in percent
PERCENT = 75
BINS = 128
BANDS = 32
GROUP = 256                 # partners compared in one task with one pivot
MAX_BROADCAST_IDS = 1_000_000
CHUNK = 256                 # members of a bucket compared with as many others in one task
TASK_ROWS = 1500            # members a task of the full comparison reads
COLUMNS = 4096              # shared shingles counted at once


def shingle_sets(buf: np.ndarray, starts: np.ndarray, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of a chunk."""
    low = lower_ascii(buf)
    a, b, first = word_spans(low, starts)
    prefix = Prefix(word_hashes(low, a, b), MULT1)
    grams = mix64(prefix.grams(shingle))
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < shingle))
    whole = mix64(prefix.ranges(first[short], first[short + 1]) + np.diff(first)[short].astype(np.uint64))
    out = []
    at = dict(zip(short.tolist(), whole))
    for j in range(len(starts) - 1):
        s, e = first[j], first[j + 1]
        if e - s >= shingle:
            out.append(np.unique(grams[s:e - shingle + 1]))
        else:
            out.append(np.array([at[j]], np.uint64) if e > s else np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """Fast similarity sketch of every non-empty set: (sets, bins) of uint64, the
    round in the top 16 bits and the value below."""
    n = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), n)
    none = np.uint64(2 ** 64 - 1)
    out = np.full((len(sets), bins), none)
    flat_out = out.reshape(-1)
    low = np.uint64(2 ** 48 - 1)
    for i in range(2 * bins):
        if not len(flat):
            break
        h = mix64(flat + np.uint64((i * 0x632BE59BD9B4E019 + 0x1234567) % 2 ** 64))
        value = (h & low) | np.uint64(i << 48)
        where = (h >> np.uint64(48)) % np.uint64(bins) if i < bins else np.full(len(h), i - bins, np.uint64)
        np.minimum.at(flat_out, owner * bins + where.astype(np.int64), value)
        live = (out == none).any(1)
        keep = live[owner]
        if not keep.all():
            flat, owner = flat[keep], owner[keep]
    return out


def _sketch(batches):
    for batch in batches:
        n_rows = batch.num_rows
        count = np.zeros(n_rows, np.int64)
        keys: list = [None] * n_rows
        bands: list = [None] * n_rows
        for i, starts, buf in text_chunks(batch.column("text")):
            sets = shingle_sets(buf, starts)
            sk = sketches(sets)
            h = np.zeros((len(sets), BANDS), np.uint64)
            for r in range(BINS // BANDS):
                h = mix64(h * np.uint64(MULT1) + sk[:, r::BINS // BANDS])
            h ^= mix64(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :]
            for j, s in enumerate(sets):
                count[i + j] = len(s)
                if len(s):
                    keys[i + j] = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    bands[i + j] = h[j].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(count), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "set_key", "bands"])


def _verify(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of one pivot (rows with a = b) with a bounded number of partners."""
    texts = pa.array(pdf["text"].tolist(), pa.large_string())
    sets: list[np.ndarray] = []
    for _, starts, buf in text_chunks(texts):
        sets += shingle_sets(buf, starts)
    pivot = (pdf["a"] == pdf["b"]).to_numpy()
    b = pdf["b"].to_numpy()
    hit = set()
    for p in np.flatnonzero(pivot):
        for j in np.flatnonzero(~pivot):
            both = len(np.intersect1d(sets[p], sets[j], assume_unique=True))
            if 100 * both >= PERCENT * (len(sets[p]) + len(sets[j]) - both):
                hit.add(int(b[j]))
    out = sorted(hit)
    return pd.DataFrame({"a": np.full(len(out), pdf["a"].iloc[0], np.int64), "b": np.array(out, np.int64)})


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar.  A pivot's partners
    are dealt over tasks of about ``GROUP`` rows, its own text goes to each."""
    size = pairs.groupBy("a").agg(F.count("*").alias("c"))
    parts = F.ceil(F.col("c") / GROUP).cast("int")
    size = size.select("a", parts.alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    members = (pairs.join(size, "a").withColumn("part", part)
               .join(texts.withColumnRenamed("id", "b"), "b").select("a", "part", "b", "text"))
    pivots = (size.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .join(texts.withColumnRenamed("id", "a"), "a").select("a", "part", F.col("a").alias("b"), "text"))
    return members.unionByName(pivots).groupBy("a", "part").applyInPandas(_verify, "a bigint, b bigint")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of slabs of the 0/1 matrix
    of the shingles that at least two sets hold."""
    n = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    o = np.argsort(flat, kind="stable")
    flat, owner = flat[o], owner[o]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    col = np.cumsum(new) - 1
    shared = np.bincount(col)[col] > 1
    owner, col = owner[shared], col[shared]
    col = np.unique(col, return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS):
        part = slice(*np.searchsorted(col, [lo, lo + COLUMNS]))
        slab = np.zeros((len(sets), COLUMNS), np.float32)
        slab[owner[part], col[part] - lo] = 1
        out += slab @ slab.T
    return out


def _grid(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links that join components, within pairs of chunks (h, i, j)."""
    texts = pdf.drop_duplicates(["id", "text"])             # an id may stand for several texts
    found: list[np.ndarray] = []
    for _, starts, buf in text_chunks(pa.array(texts["text"].tolist(), pa.large_string())):
        found += shingle_sets(buf, starts)
    sets = dict(zip(zip(texts["id"].tolist(), texts["text"].tolist()), found))
    out: list = []
    for _, part in pdf.groupby(["h", "i", "j"]):
        if part["c"].nunique() < 2:
            continue
        ids, c = part["id"].tolist(), part["c"].tolist()
        own = [sets[x] for x in zip(ids, part["text"].tolist())]
        n = np.array([len(x) for x in own])
        both = common_counts(own)
        near = 100 * both >= PERCENT * (n[:, None] + n[None, :] - both)
        joined: dict = {}

        def top(x):
            while joined.get(x, x) != x:
                x = joined[x]
            return x
        for x, y in np.argwhere(np.triu(near, 1)).tolist():
            a, b = top(c[x]), top(c[y])
            if a != b:
                joined[max(a, b)] = min(a, b)
                out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
    return pd.DataFrame(sorted(set(out)), columns=["a", "b"]).astype("int64")


def bucket_links(cells: DataFrame, comp: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different components inside the buckets ``cells`` (h, id)."""
    c = cells.join(comp.select(F.col("node").alias("id"), F.col("root").alias("c")), "id", "left")
    c = staged(c.withColumn("c", F.coalesce("c", "id")), "cells")
    mixed = c.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n"))
    mixed = staged(mixed.filter("lo < hi").select("h", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "mixed")
    own = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    c = c.join(mixed, "h").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    c = staged(c.select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "c"), "chunks")
    tasks = max(1, c.count() // TASK_ROWS)
    return (c.join(texts, "id").withColumn("task", F.pmod(F.xxhash64("h", "i", "j"), F.lit(tasks)))
            .groupBy("task").applyInPandas(_grid, "a bigint, b bigint"))


def near_dup_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id (smallest id with the same
    set) for every row of ``docs`` (doc_id, text)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sk = staged(d.mapInArrow(_sketch, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>"), "sketch")
    thin = sk.select("doc_id", "n_shingles", "set_key")
    first = thin.filter("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("class_id"))
    first = staged(first, "classes")        # written, so that the joins below have plain exchanges they can split
    members = staged(thin.join(first, "set_key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id")), "members")
    # one row per class and band; the key tells apart two texts of one id
    ones = sk.join(first.withColumnRenamed("class_id", "doc_id"), ["set_key", "doc_id"], "left_semi")
    own_links, several = shared_ids(members)
    cells = ones.select(F.col("doc_id").alias("id"), F.explode("bands").alias("h"))
    heads = staged(cells.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z").drop("z"), "heads")
    cells = staged(cells.join(heads, "h").select("h", "a", "id").distinct(), "cells")
    stars = staged(cells.filter("a < id").select("a", F.col("id").alias("b")).distinct(), "stars")
    ids = cells.select("id").distinct()
    n_ids = ids.count()
    if n_ids == 0:
        return _finish(members, components(own_links) if own_links is not None else None, several)
    # ids are counted first: a bounded list is broadcast, a longer one is joined by shuffle
    ids = F.broadcast(ids) if n_ids <= MAX_BROADCAST_IDS else ids
    texts = staged(d.withColumnRenamed("doc_id", "id").join(ids, "id", "left_semi").distinct(), "texts")

    nearest = staged(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
    links = verified(nearest, texts)
    links = staged(links if own_links is None else links.unionByName(own_links), "links")
    comp = components(links)
    more = bucket_links(cells.select("h", "id"), comp, texts)
    return _finish(members, components(staged(links.unionByName(more), "links")), several)


def shared_ids(members: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """Ids whose rows differ in class or lack a set: links between all classes of an id (a, b), and
    the class that stands for the id (doc_id, id_class).  None without such ids."""
    per = members.filter("doc_id is not null").groupBy("doc_id").agg(
        F.min("class_id").alias("id_class"), F.max("class_id").alias("top"), F.count("class_id").alias("sets"), F.count("*").alias("n"))
    per = staged(per.filter("n > 1 and sets > 0 and (id_class < top or sets < n)").select("doc_id", "id_class"), "shared-ids")
    if per.isEmpty():
        return None, None
    links = members.join(per, "doc_id").filter("class_id > id_class").select(F.col("id_class").alias("a"), F.col("class_id").alias("b"))
    return staged(links.distinct(), "own-links"), per


def _finish(members: DataFrame, comp: DataFrame | None, several: DataFrame | None) -> DataFrame:
    own = F.coalesce("root", "class_id", "doc_id")
    if several is not None:
        # rows of one id share its component, also those without a set
        members = members.join(several, "doc_id", "left").withColumn("class_id", F.coalesce("id_class", "class_id")).drop("id_class")
    if comp is None:
        joined = members.withColumn("root", F.lit(None).cast("long"))
    else:
        joined = members.join(comp, members["class_id"] == comp["node"], "left")
    return joined.select("doc_id", "n_shingles", own.alias("component_id"),
                         F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"), "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) without near duplicates: one document of each
    component stays, and one row of it.  Rows without an id all stay."""
    classes = staged(near_dup_classes(docs).select("doc_id", "kept"), "kept")
    gone = classes.filter("not kept and doc_id is not null").select("doc_id").distinct()
    n = gone.count()
    # ids are counted first: a bounded list is broadcast, a longer one is joined by shuffle
    left = docs.join(F.broadcast(gone) if n <= MAX_BROADCAST_IDS else gone, "doc_id", "left_anti").select(*docs.columns)
    again = classes.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if again.isEmpty():
        return left
    # rows that share an id: the one with the smallest text hash
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    return left.withColumn("__nth", F.when(F.col("doc_id").isNull(), F.lit(1)).otherwise(nth)).filter("__nth = 1").drop("__nth")
