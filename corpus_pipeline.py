"""The corpus pipeline: from documents to packed token sequences.

Each stage takes what its predecessor kept, as a table that was written and read
again, and applies one operator of ``millrace.llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import line_quality
from millrace.llm.common import held_out, stored, table
from millrace.llm.decontamination import without_leaks
from millrace.llm.line_dedup import deduplicated_lines
from millrace.llm.near_duplicates import deduplicated
from millrace.llm.packing import pack


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts."""
    model = line_quality.fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return line_quality.accepted(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds; ``n_chars`` follows the text."""
    rows = deduplicated_lines(docs)
    chars = F.when(F.col("removed_lines") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", chars.cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return deduplicated(docs).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained classifier, an alignment and a linear program are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
