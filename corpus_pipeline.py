"""From raw documents to a training mix: each stage applies one operator to all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, lines, mixing, parity, quality
from tidemark.session import stage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the compression classifier rejects; fitted on their labels that are not held out."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand in more than a tenth of their source's documents; no document goes."""
    return lines.drop_frequent_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its shingles of five words, linked directly or through others."""
    return parity.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark text."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once per epoch they appear in, with ``mix_epoch`` and ``mix_taken`` words."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", source_mix),
]

#: SQL cannot express the classifier; tests/llm compares the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written once to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
