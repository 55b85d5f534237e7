"""Corpus pipeline: quality rules, near-dedup, substring dedup, decontamination,
byte-level BPE. Each stage takes (spark, docs, sf_dir) and works on all rows its
predecessor kept; `run` writes each result as Parquet and reads it again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, near_dup, quality_rules, substring, tiling
from skyledger.llm import common as C


def _ready(spark: SparkSession) -> None:
    C.workers_see_package(spark)
    C.checkpoint_dir(spark)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    _ready(spark)
    return quality_rules.keep_clean(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (the smallest doc_id)."""
    _ready(spark)
    return near_dup.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated 35-word windows; n_chars follows the text."""
    _ready(spark)
    return substring.cut_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item covers."""
    _ready(spark)
    return tiling.drop_contaminated(docs, C.table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every kept text, as digests."""
    import public_tokenizers

    _ready(spark)
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("byte_bpe", bpe_stage),
]

#: Kneser-Ney perplexity, greedy tiling and BPE merges are not SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    _ready(spark)
    docs = C.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = C.stored(docs, name)
    return docs
