"""Mixing sources to target weights by a low-discrepancy source schedule (native).

The mix is a sequence of slots.  Slot ``i`` gets the ``i``-th van der Corput
point (the bit reversal of ``i``), which is mapped through the cumulative slot
weights to a source; the ``r``-th slot of a source takes the ``r``-th block of
``block_words`` words of that source's documents, laid end to end in a shuffled
order and repeated from the start when the source is used up.  So every prefix
of the schedule holds the sources near their weights, and every source's total
is exactly its rounded target (its last block is cut short).

Defined cases: a null text has size 0; a null source is a source of its own
(ordered last); documents of size 0 take nothing; an empty table gives an
empty result; repeated rows are separate documents; a very long text spans several blocks;
a mix beyond ``MAX_SLOTS`` slots takes larger blocks; further columns of the
input are ignored, whatever they are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import staged, word_count

WEIGHTS = (5, 2, 1)         # fixed values: weights by rank of the source, repeating
CAP = 3                     # fixed value: at most this many times a source's own size
BLOCK_WORDS = 4096
LINE_DIGITS = 3             # a source's line is laid in 16**3 shuffled ranges
MAX_SOURCES = 100_000       # size up to which the table of sources is broadcast
SALTS = 64
MAX_SLOTS = 1 << 30         # beyond, blocks grow (a point times the number of slots must fit 63 bits)


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: key, source, source_size, target.

    Capped shares in closed form: sources are filled in the order of
    ``source_size / weight``; a source is capped when its even share of what the
    earlier, capped ones leave would exceed ``cap`` times its size.  The windows
    run over one row per source (never over documents).
    """
    per = (sizes.groupBy("key").agg(F.first("source", ignorenulls=True).alias("source"),
                                    F.sum("size").alias("source_size")))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("limit", F.lit(cap) * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
             / F.sum("weight").over(after))
    per = (per.withColumn("level", level).withColumn("nth", F.row_number().over(order))
              .withColumn("full", F.col("level") * F.col("weight") >= F.col("limit")))
    # the first source that is not capped fixes the level of all that follow
    share = F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), F.col("nth"))).over(every)
    return per.select("key", "source", "source_size",
                      F.when(F.col("full"), F.col("limit").cast("double"))
                       .otherwise(share * F.col("weight")).alias("target"))


def _attach_sources(df: DataFrame, per: DataFrame, n_sources: int) -> DataFrame:
    """Join per-source values to documents; a hot source never meets in one task:
    the small table is broadcast up to ``MAX_SOURCES`` rows, else salted."""
    if n_sources <= MAX_SOURCES:
        return df.join(F.broadcast(per), "key")
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return (df.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
              .join(per.withColumn("salt", salt), ["key", "salt"]).drop("salt"))


def lay_lines(docs: DataFrame) -> DataFrame:
    """Start of every document in its source's shuffled line of words.

    The line is ordered by the md5 of the id; it is summed inside the ranges of
    equal leading digits (``LINE_DIGITS``) per source, then over the ranges, so
    no task holds a whole source."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    part = F.substring(digest, 1, LINE_DIGITS)
    d = docs.withColumn("part", part).withColumn("digest", digest)
    within = (Window.partitionBy("key", "part").orderBy("digest", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    heads = docs.withColumn("part", part).groupBy("key", "part").agg(F.sum("size").alias("part_size"))
    over = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("key", "part", F.coalesce(F.sum("part_size").over(over), F.lit(0)).alias("head"))
    return d.join(heads, ["key", "part"]).withColumn("start", F.col("head") + F.col("inner")).drop("part", "digest", "inner", "head")


def schedule(per: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: slot (order), key, rank (of the slot in its source)."""
    spark = per.sparkSession
    per = per.withColumn("n_slots", F.ceil(F.round("target") / block_words).cast("long")).filter("n_slots > 0")
    over = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("lo", F.coalesce(F.sum("n_slots").over(over), F.lit(0)))
    total = per.agg(F.sum("n_slots")).first()[0] or 0
    bits = max(1, math.ceil(math.log2(max(total, 2))))
    width = 1024
    # point v of the sequence, scaled to the slots' total, falls in the source
    # whose [lo, lo + n_slots) holds it; an equi-join on cells of that axis finds it
    slots = spark.range(1 << bits).select(
        F.conv(F.reverse(F.lpad(F.bin("id"), bits, "0")), 2, 10).cast("long").alias("slot"),
        F.shiftright(F.col("id") * F.lit(total), bits).alias("x"))
    slots = slots.withColumn("cell", F.floor(F.col("x") / width).cast("long"))
    cells = per.select("key", "lo", "n_slots", F.explode(F.sequence(
        F.floor(F.col("lo") / width), F.floor((F.col("lo") + F.col("n_slots") - 1) / width))).alias("cell"))
    hit = (slots.join(cells, "cell")
           .filter((F.col("x") >= F.col("lo")) & (F.col("x") < F.col("lo") + F.col("n_slots")))
           .select("slot", "key", "n_slots"))
    # rank inside the source: rank in a stretch of slots plus the count of the earlier stretches
    hit = hit.withColumn("stretch", F.floor(F.col("slot") / 65536))
    counts = hit.groupBy("key", "stretch").count()
    earlier = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key", "stretch", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    inner = Window.partitionBy("key", "stretch").orderBy("slot")
    hit = (hit.withColumn("nth", F.row_number().over(inner) - 1).join(counts, ["key", "stretch"])
              .withColumn("rank", F.col("nth") + F.col("base")))
    return hit.filter(F.col("rank") < F.col("n_slots")).select("slot", "key", "rank")


def block_size(per: DataFrame, block_words: int = BLOCK_WORDS) -> int:
    """``block_words``, doubled until the mix of ``per`` has at most ``MAX_SLOTS`` slots (and one more a source)."""
    words = per.agg(F.sum(F.round("target"))).first()[0] or 0
    while words / block_words > MAX_SLOTS:
        block_words *= 2
    return block_words


def mix_sources(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """Returns (documents, segments).

    documents: doc_id, source, size, source_size, target, key, start (of the
    document in its source's line).  segments: the mix itself, one row per
    piece of a document in a slot: slot, key, start, doc_id, size, words taken.
    """
    sized = staged(docs.select(F.col("doc_id"), F.col("source"), _key(F.col("source")).alias("key"),
                               word_count(F.col("text")).alias("size")), "mix-sizes")
    per = staged(source_targets(sized, weights, cap), "mix-sources")
    n_sources = per.count()
    block_words = block_size(per, block_words)
    lines = _attach_sources(lay_lines(sized), per.drop("source"), n_sources)
    lines = staged(lines, "mix-lines")
    want = F.round("target").cast("long")
    # a document's copies on the endless line: one per pass through its source
    passes = F.sequence(F.lit(0), F.lit(cap - 1))
    copies = (lines.filter("size > 0").withColumn("pass", F.explode(passes))
              .withColumn("lo", F.col("start") + F.col("pass") * F.col("source_size"))
              .withColumn("hi", F.least(F.col("lo") + F.col("size"), want))
              .filter("lo < hi"))
    pieces = (copies.withColumn("rank", F.explode(F.sequence(F.floor(F.col("lo") / block_words),
                                                             F.floor((F.col("hi") - 1) / block_words))))
              .withColumn("words", F.least(F.col("hi"), (F.col("rank") + 1) * block_words)
                          - F.greatest(F.col("lo"), F.col("rank") * block_words))
              .select("key", "rank", "start", "doc_id", "size", "words"))
    segments = pieces.join(schedule(per, block_words), ["key", "rank"])
    return lines, segments


def taken_words(docs: DataFrame, **kw) -> DataFrame:
    """Digest of the mix per document: doc_id, size, source_size, target, taken,
    source, key, start, first_slot (first slot that takes it, null if none)."""
    lines, segments = mix_sources(docs, **kw)
    got = (segments.groupBy("key", "start", "doc_id", "size").agg(F.sum("words").alias("got"), F.min("slot").alias("first_slot"))
           .withColumnRenamed("doc_id", "id").alias("g"))
    # the place on the line tells apart repeated rows of one id
    same = ((F.col("l.key") == F.col("g.key")) & (F.col("l.start") == F.col("g.start"))
            & (F.col("l.size") == F.col("g.size")) & F.col("l.doc_id").eqNullSafe(F.col("g.id")))
    return (lines.alias("l").join(got, same, "left")
            .select("doc_id", "l.size", "source_size", "target",
                    F.coalesce(F.col("got"), F.lit(0)).cast("long").alias("taken"), "source", "first_slot"))
