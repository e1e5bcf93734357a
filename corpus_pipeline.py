"""The corpus pipeline: rules, near duplicates, repeated passages, benchmarks, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeledger.llm import decontamination, near_copies, quality, sentencepiece_codec, simhash, substring_dedup
from codeledger.llm.tables import ready, table
from codeledger.session import checkpointed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the adaptive rules keep."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id.

    SimHash links, 64 bits of three-word shingles within 3 bits, as op5; what so few bits miss at
    five words and a similarity of 0.8 is added by wide fingerprints and counted.
    """
    ready(spark)
    return near_copies.keep_least(docs, simhash.near_duplicates, near_copies.near_copies)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one holds; n_chars follows the text."""
    ready(spark)
    rows = substring_dedup.remove_repeats(docs)
    columns = [F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return rows.select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a benchmark passage."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids, decoded text and spans of every document."""
    ready(spark)
    return sentencepiece_codec.encode(docs.select("doc_id", "text"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup_stage),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece", encode),
]

#: SQL has neither XXH64 nor SentencePiece; a brute-force version tests run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
