"""Registered queries of the corpus operators: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.llm import (audit, chat, counts, decontaminate, huffman, line_dedup, lm, packing, pii, quality, search,
                        simhash, urlfilter)
from engage.llm.common import table


def op1_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.round_trip(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", "text")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"),
                        F.size("matches").cast("long").alias("n_items"),
                        F.transform("matches", lambda m: m["item_id"]).alias("item_ids"),
                        F.transform("matches", lambda m: m["edits"]).alias("edits"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_failed", "host_bad")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts hold control strings."""
    extra = [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turns.unionByName(spark.createDataFrame(extra, "conv_id long, turn long, role string, text string"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.round_trip(conversations(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_edited(table(spark, sf_dir, "documents"))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), urlfilter.rules_table(spark)).select(
        "page_id", "host", "path", "rule", "verdict", "pattern")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.build_index(table(spark, sf_dir, "documents"))
    return search.search(index, table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_huffman": op1_huffman,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_chat": op6_chat,
    "op7_simhash": op7_simhash,
    "op8_pii": op8_pii,
    "op9_token_counts": op9_token_counts,
    "op10_language_model": op10_language_model,
    "op11_url_filter": op11_url_filter,
    "op12_ranked_search": op12_ranked_search,
    "op13_filter_audit": op13_filter_audit,
}
