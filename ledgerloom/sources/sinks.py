"""Table and text sinks.

Report tables live in a versioned store (``sources/store.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.store import BASE, DELTA, Store
from ledgerloom.sources.tables import ReportTable


def write_report(df: DataFrame, table: ReportTable, folder: str) -> int:
    """Replace the whole table; returns the version that shows it."""
    store = Store(df.sparkSession, folder)
    return store.publish({table.name: (BASE, store.write(df, table))})


def upsert_report(arriving: DataFrame, table: ReportTable, folder: str) -> int:
    """Insert or replace rows by key: only the arriving rows are written.

    A table that is not there yet counts as empty.
    """
    store = Store(arriving.sparkSession, folder)
    return store.publish({table.name: (DELTA, store.write(arriving, table))})


def read_report(spark: SparkSession, table: ReportTable, folder: str) -> DataFrame:
    """The table as of the latest version. Read several tables through one ``Store.snapshot``."""
    return Store(spark, folder).snapshot().read(table)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it back: cuts lineage, survives the loss of executors.

    Unlike a cached frame, the staged table serves each reader just its columns.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_text(df: DataFrame, path: str) -> None:
    """Write a one-column frame of text lines."""
    df.write.mode("overwrite").text(path)
