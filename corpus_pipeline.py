"""Corpus pipeline: from the ``documents`` table to token files.

Five stages, each over all rows that the one before kept: toxic documents go, one document of
each group of near copies stays, documents with benchmark passages go, the sources are mixed
to their target weights, and what remains is written as token files. Every stage but the last
returns the columns of ``documents``; the last returns one row per document of the mix, read
back from the files.

Rows without a doc_id, with null or empty texts and repeated rows pass as each operator says;
an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import common, decontaminate, mixing, near_dedup, token_files, toxicity


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity 0.8 or more."""
    return near_dedup.deduplicated(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending doc_id order, read back: doc_id, start, n_tokens, ids_crc32.

    Workers that ran the other stages hold memory, so few pieces are remembered.
    """
    return token_files.report(docs, public_tokenizers.path("byte_bpe_50k.json"), remembered=1 << 17)


STAGES = [
    ("toxicity", remove_toxic),
    ("MinHash near-dedup", remove_near_copies),
    ("benchmark decontamination", remove_contaminated),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", write_tokens),
]

# SQL has no counterpart of the classifier and the tokenizer; tests/llm/test_pipeline.py holds
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = common.staged(stage(spark, docs, sf_dir), f"stage{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
