"""Helpers that the text operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Fixed character classes of the word patterns used here. Both are byte-wise, and bytes
# from 0x80 on (all of a non-ASCII character) always belong to a word.
SPACES = " \\x09-\\x0D"
WORD_PATTERN = f"[^{SPACES}]+"

# Rows and bytes of one Arrow batch: bounds what a Python worker holds at once, also where
# a table has many very long texts.
BATCH_ROWS = 2000
BATCH_BYTES = 4 * 1024 * 1024

_UPPER = bytes(range(65, 91))
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())


def configure(spark: SparkSession) -> None:
    """Bound Arrow batches, let AQE split hot join keys, and let Spark thin large tables before a join by a
    Bloom filter of the ids they are joined with (runtime settings only)."""
    for key, value in {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "16MB",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none (tests, a laptop), a folder below the warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared one, for one run."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage.

    A lost executor then costs a read of that table and no recomputation.
    """
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Staged tables that only one computation reads; ``remove`` deletes them once its result is written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.tables = spark, run_folder(spark, name), 0

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        """As ``staged``, below the folder of this computation."""
        path = f"{self.folder}/{self.tables}-{name}"
        self.tables += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, *tables: DataFrame) -> None:
        """Delete these tables, or all."""
        for path in [t.inputFiles()[0].rsplit("/", 1)[0] for t in tables if t.inputFiles()] if tables else [self.folder]:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def count_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with bounded batches; a worker gives its memory back at the end of a task."""
    configure(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def release_memory() -> None:
    """Return what Arrow and the C library keep for later to the system: workers stay, other tasks follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a text column, without decoding."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def in_training(doc_id: Column, folds: int, held_out: int) -> Column:
    """False for the rows whose crc32 of the id as text leaves ``held_out``."""
    return F.crc32(doc_id.cast("string")) % folds != held_out
