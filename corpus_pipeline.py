"""From raw documents to packed training sequences.

Quality rules drop outliers, the n-gram join keeps one document of every group
of near copies, the secret scan replaces what it finds, the mix takes every
source to its target (documents may come twice or not at all) and packing turns
texts into token pieces with a place in a sequence.  Every stage but the last
returns the columns of its input; between stages the table is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordcheck.llm import mixing, ngram_join, packing, quality, secret_scan
from recordcheck.sources.storage import scratch_table
from recordcheck.sources.tables import read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.quality_filter(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays."""
    return ngram_join.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced in the text."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with sequence_id and offset."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("secret_scan", secrets),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

# The models of the first stage and the tokenizer of the last are not SQL; the
# stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
