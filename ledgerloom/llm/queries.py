"""One registered query per text operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import (
    context_mixing, decontaminate, fill_in_middle, fingerprints, labelled, mixing, near_dedup, packing, pii, quality,
    secrets, token_files, toxicity, whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_benchmark_decontamination(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_minhash_near_dedup(spark, sf_dir):
    return near_dedup.groups(table(spark, sf_dir, "documents"), shingle=2)


@query
def op8_quality_classifier(spark, sf_dir):
    scored = quality.scored(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return labelled.digest(scored, quality.THRESHOLD)


@query
def op9_toxicity(spark, sf_dir):
    scored = toxicity.scored(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return labelled.digest(scored, toxicity.THRESHOLD)


@query
def op7_mixing_sources(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))


@query
def op2_phrase_fingerprints(spark, sf_dir):
    return fingerprints.report(table(spark, sf_dir, "documents"))


@query
def op3_token_files(spark, sf_dir):
    return token_files.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_context_mixing(spark, sf_dir):
    return context_mixing.scores(table(spark, sf_dir, "documents"))


@query
def op5_secret_scan(spark, sf_dir):
    return secrets.findings(table(spark, sf_dir, "documents"))


@query
def op6_personal_data(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op13_fill_in_middle(spark, sf_dir):
    return fill_in_middle.report(table(spark, sf_dir, "documents"))


@query
def op11_embedding_whitening(spark, sf_dir):
    return whitening.report(table(spark, sf_dir, "embeddings"))


@query
def op12_window_packing(spark, sf_dir):
    return packing.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
