"""The corpus pipeline: documents through quality rules, near-duplicate removal, decontamination,
secret masking and encoding.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns
of documents, the last one its encoded rows. Results are written as Parquet and read again between
stages, so a lost executor costs no finished stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bpe, decontaminate, near_dup, quality_rules, secret_scan
from marquee.llm.common import Scratch, table

NEAR_PERCENT = 80
# The rows depend on hashes and on a tokenizer's merges, which SQL cannot express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail are gone, and documents that lose too much."""
    return quality_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share 80 % of their shingles stays."""
    return near_dup.deduplicate(docs, NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item are gone."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked."""
    return secret_scan.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source with the ids of the text and their digests."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id", "lang", "source"])


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
