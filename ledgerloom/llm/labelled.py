"""Labelled rows for classifiers, and scoring of whole tables with a trained model.

Labels are learned only from rows whose crc32 of the id as text, mod ``FOLDS``, is not
``HELD_OUT``, and from at most ``SAMPLE_ROWS`` of them, those with the smallest hash of the id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.llm import common

FOLDS = 5
HELD_OUT = 0
SAMPLE_ROWS = 20_000


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def training_sample(labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` training rows: doc_id, label, fold. One row for each id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(
        F.max(F.col(label).cast("int")).alias("label"))
    return known.withColumn("fold", fold(F.col("doc_id"))).where(F.col("fold") != HELD_OUT).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)


def sampled_documents(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, text, label, fold of the sampled rows; the sample's bound allows the broadcast."""
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")


def feature_rows(docs: DataFrame, extract: Callable[[bytes | None], list[float]]) -> DataFrame:
    """doc_id, label, fold and the features of sampled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [extract(text) for text in common.texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), batch.column("fold"),
                 pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "label", "fold", "features"])

    return common.map_batches(docs, run, T.StructType([
        docs.schema["doc_id"], T.StructField("label", T.IntegerType()), T.StructField("fold", T.LongType()),
        T.StructField("features", T.ArrayType(T.DoubleType()))]))


def collected(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and folds of the sample on the driver, one row for each id."""
    table = rows.dropDuplicates(["doc_id"]).orderBy("doc_id").toArrow()
    if not table.num_rows:
        return np.zeros((0, width)), np.zeros(0), np.zeros(0, dtype=np.int64)
    features = np.asarray(table.column("features").combine_chunks().flatten()).reshape(-1, width)
    return features, np.asarray(table.column("label")), np.asarray(table.column("fold"))


def scored(docs: DataFrame, model, score: str) -> DataFrame:
    """``docs`` with a column of scores. ``model.score`` takes a list of texts in UTF-8.

    A column that has the name of the score is replaced.
    """
    handle = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != score]
    source = docs.select(*kept)
    names = [*kept, score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = handle.value.score(common.texts_of(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=names)

    return common.map_batches(source, run, T.StructType(
        [T.StructField(f.name, f.dataType) for f in source.schema] + [T.StructField(score, T.DoubleType())]))


def digest(docs: DataFrame, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
                       "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
