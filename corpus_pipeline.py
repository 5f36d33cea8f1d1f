"""From raw documents to packed token sequences, in five stages.

Each stage reads what the one before kept, applies one operator of `feedlake.llm` and
returns documents; the last returns packed pieces. Between stages the rows are
written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlake.llm import decontam, linedup, packing, quality, simhash
from feedlake.llm.common import cut_lineage, documents, table
from feedlake.llm.queries import TOKENIZER

# Tokenization has no counterpart in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.kept_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go, and documents that lose all their words."""
    return linedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.deduplicated(docs, simhash.SHINGLE_WORDS, simhash.MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack_documents(docs, **TOKENIZER())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
