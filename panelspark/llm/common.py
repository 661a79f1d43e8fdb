"""Helpers shared by the text operators: shared work tables, hashing of
concatenated byte buffers with numpy, and Arrow column access."""

from __future__ import annotations

import gc
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import checkpoint_dir, ship_package

# fixed value: a word is a maximal run of characters other than space and \t..\r
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

MULT = np.uint64(0x9E3779B97F4A7C15)          # fixed value: odd 64-bit constant (golden ratio)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)         # fixed values: splitmix64 finaliser
MIX_B = np.uint64(0x94D049BB133111EB)
ARROW_ROWS = 1024


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers and keep Arrow batches of long texts
    small (a batch of 10,000 very long texts would not fit an executor)."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: the
    lineage ends there, so a lost executor costs only unfinished tasks."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of frames no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def doc_bucket(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(n)


# ------------------------------------------------------------------ numpy side

def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_A
    x ^= x >> np.uint64(27)
    x *= MIX_B
    x ^= x >> np.uint64(31)
    return x


_POW: dict[int, np.ndarray] = {}


def powers(n: int, mult: int = int(MULT)) -> np.ndarray:
    """mult**0 .. mult**(n-1) modulo 2**64 (grown by doubling, kept)."""
    p = _POW.get(mult)
    if p is None or len(p) < n:
        size = 1 << max(10, (n - 1).bit_length())
        p = np.ones(1, np.uint64)
        while len(p) < size:
            step = np.uint64(pow(mult, len(p), 1 << 64))
            p = np.concatenate([p, p * step])
        _POW[mult] = p
    return p[:n]


def text_chunks(col: pa.Array, limit: int = 1 << 20):
    """Yield (first row, row starts, byte buffer) over runs of rows whose bytes
    total about ``limit`` (one longer row forms its own run).  A null is an
    empty text.  ``starts`` has one entry more than rows."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if len(col) == 0:
        return
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        off_t = np.int64
    else:
        off_t = np.int32
    _, off, data = col.buffers()
    offs = np.frombuffer(off, off_t)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        j = min(j, len(col))
        yield i, offs[i:j + 1] - offs[i], raw[offs[i]:offs[j]]
        i = j


def word_spans(buf: np.ndarray, starts: np.ndarray):
    """Start and end of every word in the concatenated texts and, per text,
    the index of its first word (one entry more than texts)."""
    sep = (buf == 32) | ((buf >= 9) & (buf <= 13))
    word = np.zeros(len(buf) + 2, bool)
    word[1:-1] = ~sep
    edge = word[1:] != word[:-1]
    first = word[1:] & edge
    first[starts[:-1][starts[:-1] < len(buf)]] |= word[1:][starts[:-1][starts[:-1] < len(buf)]]
    last = word[:-1] & edge                 # last[i]: a word ends before position i
    cut = starts[1:-1]
    last[cut] |= word[:-1][cut]
    a = np.flatnonzero(first)
    b = np.flatnonzero(last)
    return a, b, np.searchsorted(a, starts)


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)


def word_hashes(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word [a, b): polynomial in the bytes (from the word's
    first byte) and its length, mixed."""
    if len(a) == 0:
        return np.zeros(0, np.uint64)
    n = b - a
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    pos = np.repeat(a, n) + within
    v = (buf[pos].astype(np.uint64) + np.uint64(1)) * powers(int(n.max()))[within]
    h = np.add.reduceat(v, np.cumsum(n) - n)
    return mix64(h ^ (n.astype(np.uint64) * MIX_B))


def binary_array(chunks: list[bytes]) -> pa.Array:
    return pa.array(chunks, pa.binary())
