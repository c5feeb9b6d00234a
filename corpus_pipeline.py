"""Corpus pipeline: five stages over ``documents``, each written and read again.

1. quality rules: documents that the rules reject go;
2. line dedup: later matches of a line are cut from the texts;
3. SimHash near-dedup: one document of each group stays;
4. benchmark decontamination: documents with a benchmark passage go;
5. best-fit packing: the pieces of the documents left, with their bins.

All but the last stage return the columns of ``documents``.  Each stage works
on what its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from engage.llm import decontaminate, line_dedup, packing, quality, simhash
from engage.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_documents(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]

#: Fingerprints, alignments and best fit have no SQL form; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
