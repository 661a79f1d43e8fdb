"""From raw documents to a training mix: five stages, each written and read again.

language ID, MinHash near-dedup, substring dedup, benchmark decontamination, source
mixing.  Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  An empty input passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import debruijn, decontaminate, language_id, mixing, near_dup
from panelspark.llm.common import prepare, staged, table

ORACLE_SQL = None           # SQL cannot express the stages; tests hold them against brute force


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    prepare(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return near_dup.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the windows of 20 words that start earlier elsewhere;
    n_chars counts what is left.  No row goes."""
    prepare(spark)
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    left = debruijn.dedup_words(docs, rest, with_text=True).withColumnRenamed("kept", "text")
    left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words every document gives to the mix: doc_id, source, size, source_size,
    target, taken and the first slot of the schedule that takes it."""
    prepare(spark)
    return mixing.taken_words(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole ``documents`` table."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
