"""Queries on texts and pages: op1 (decontamination), op2 (repeated words), op3 (HTML), op5 (language), op6 (repeated bytes), op7 (language model), op9 (near duplicates)."""

from __future__ import annotations

from panelspark.llm import debruijn, decontaminate, html_text, language_id, lm_score, near_dup, suffix_dedup
from panelspark.llm.catalog import query
from panelspark.llm.common import table


@query("op1_decontaminate")
def op1(spark, sf_dir):
    """Every document and benchmark item it holds, with the best window."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_repeated_words")
def op2(spark, sf_dir):
    """What is left of every document without repeated windows of 20 words."""
    got = debruijn.dedup_words(table(spark, sf_dir, "documents"), ["doc_id"])
    return got.withColumnRenamed("kept", "kept_sha256")


@query("op3_html_text")
def op3(spark, sf_dir):
    """Main text of every page."""
    got = html_text.main_text(table(spark, sf_dir, "pages"))
    return got.select("page_id", "url", "text", "n_chars", "n_blocks", "n_kept")


@query("op5_language_id")
def op5(spark, sf_dir):
    """Language of every text by PPM code length."""
    return language_id.identify(table(spark, sf_dir, "documents"))


@query("op6_repeated_bytes")
def op6(spark, sf_dir):
    """What is left of every text without repeated strings of 100 bytes."""
    return suffix_dedup.dedup_bytes(table(spark, sf_dir, "documents"), ["doc_id"])


@query("op7_lm_score")
def op7(spark, sf_dir):
    """Model and base score of every text."""
    return lm_score.score_texts(table(spark, sf_dir, "documents"))


@query("op9_near_dup")
def op9(spark, sf_dir):
    """Near-duplicate component of every document."""
    got = near_dup.near_dup_classes(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_shingles", "component_id", "kept")
