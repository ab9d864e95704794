"""The corpus pipeline: quality rules, near duplicates, substring dedup, secret scan, packing.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the
columns of ``documents``.  ``run`` writes every stage's rows to the shared
folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.chaining import remove_repeats
from ledgerline.llm.common import staged, words
from ledgerline.llm.jaccard import keep_one
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.quality import quality_filter
from ledgerline.llm.registry import BYTE_BPE, tokenizer_file
from ledgerline.llm.secrets import redact
from ledgerline.sources.tables import read_test_table


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, where the table has that column."""
    return docs.select(*(F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_filter(docs, read_test_table(spark, sf_dir, "labels"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return keep_one(docs, width=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have; those left without a word go."""
    cut = remove_repeats(docs)
    return _sized(cut.where(F.size(words(F.col("text"))) > 0))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret masked."""
    return _sized(redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, packed into sequences of 2048."""
    return pack_documents(docs, tokenizer_file(BYTE_BPE), capacity=2048, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the similarity join, the chaining and the tokenizer; tests/llm hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to packed pieces."""
    docs = read_test_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
