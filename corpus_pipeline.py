"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet into the shared folder and reads it again as
the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.llm.common import stored, table
from recordflow.llm.fertility import keep_fertile
from recordflow.llm.fmindex import decontaminate
from recordflow.llm.linetree import drop_recurring_lines
from recordflow.llm.minhash import drop_near_duplicates
from recordflow.llm.packing import pack


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base counts or the fertility bands reject go."""
    return keep_fertile(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates stay in one document each."""
    return _with_length(drop_recurring_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (5 words, 0.8)."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of benchmark windows are cut out of the texts."""
    return _with_length(decontaminate(docs, table(spark, sf_dir, "benchmark")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed at the mixture of their sources."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # the stages use vocabularies and sketches that SQL can't express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline/{name}")
    return docs
