"""From raw documents to packed training sequences.

Each stage takes the documents that its predecessor kept; ``run`` writes every
stage's rows to the shared folder and reads them back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txrisk.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from txrisk.llm.common import stored, table
from txrisk.llm.queries import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and lines above the limits of their source."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go, and documents that are nothing else."""
    return line_dedup.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays."""
    return ngram_join.representatives(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled inside its shards."""
    return mixing.mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in the sequences."""
    return packing.pack(docs, TOKENIZER, added_tokens=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("mixing", mixture),
    ("packing", packed),
]

# Hashes choose the mix and the packing, and DuckDB has no such tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), f"stage-{name}")
    return rows
