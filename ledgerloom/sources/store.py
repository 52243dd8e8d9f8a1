"""Versioned store of the report tables.

    <folder>/<table>/<part>/...       Parquet, by deal date where the table has one: a whole table (base),
                                      or the rows that arrived later (delta)
    <folder>/_versions/<number>.json  the parts of every table, oldest first: a base and its deltas

Parts go to new folders, which no reader knows. A version makes them visible, of all tables that
changed at once: its file is written aside and renamed to the next number, and the rename fails
where another writer was first, who is then taken into account. Readers take the greatest number once and see
that version whatever is published meanwhile. A run that fails before it publishes leaves nothing but
folders that no version names.

A late row costs a delta with that row. Readers merge: of the deltas the last row of each key holds, and
replaces the row of the base. ``compact`` folds deltas into a new base; ``vacuum`` removes what the kept
versions do not name.

The file system must rename without overwriting (HDFS and local ones do). Where it cannot, let one writer run at a
time. Rows that arrive together have unique keys.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators.lookups import last_per_key
from ledgerloom.operators.merging import upsert
from ledgerloom.sources.tables import REPORT_TABLES, ReportTable

PARTITION = "deal_dt"
BASE, DELTA = "base", "delta"
VERSIONS = "_versions"
_SEQUENCE = "_sequence"
PUBLISH_ATTEMPTS = 20


@dataclass(frozen=True)
class Snapshot:
    """One version of all tables, as a reader sees it."""

    spark: SparkSession
    folder: str
    number: int
    parts: dict[str, list[str]]

    def read(self, table: ReportTable) -> DataFrame:
        """The rows of a table; an empty frame if the version does not have it."""
        names = self.parts.get(table.name, [])
        if not names:
            return self.spark.createDataFrame([], table.schema)
        base, *deltas = [self._part(table, name) for name in names]
        if not deltas:
            return base
        numbered = [d.withColumn(_SEQUENCE, F.lit(i)) for i, d in enumerate(deltas)]
        arrived = last_per_key(reduce(DataFrame.unionByName, numbered), *table.key, position=_SEQUENCE)
        return upsert(base, arrived, list(table.key)).select(*table.columns)

    def _part(self, table: ReportTable, name: str) -> DataFrame:
        return table.conform(self.spark.read.schema(table.schema).parquet(f"{self.folder}/{name}"))


class Store:
    """A folder with versions of ``tables``, by default those of the reports."""

    def __init__(self, spark: SparkSession, folder: str, tables: dict[str, ReportTable] = REPORT_TABLES):
        self.spark, self.folder, self.tables = spark, folder.rstrip("/"), tables

    # ------------------------------------------------------------ reading

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The latest version, or the one of this number; version 0 has no tables."""
        number = max(self.versions(), default=0) if number is None else number
        parts = json.loads(self._load(self._version_file(number))) if number else {}
        return Snapshot(self.spark, self.folder, number, parts)

    def versions(self) -> list[int]:
        names = [status.getPath().getName() for status in self._list(VERSIONS)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    # ------------------------------------------------------------ writing

    def write(self, df: DataFrame, table: ReportTable) -> str:
        """Write rows as a part, which nobody sees before it is published; returns its name."""
        name = f"{table.name.lower()}/{uuid.uuid4().hex}"
        _partitioned(table.conform(df), table).mode("error").parquet(f"{self.folder}/{name}")
        return name

    def publish(self, changes: dict[str, tuple[str, str]]) -> int:
        """Make parts visible, all at once: table name to (BASE or DELTA, part). Returns the version's number.

        A base replaces its table; a delta goes on top of the latest version, and is the base of a table
        that is not there yet.
        """
        for _ in range(PUBLISH_ATTEMPTS):
            latest = self.snapshot()
            parts = dict(latest.parts)
            for name, (kind, part) in changes.items():
                parts[name] = [part] if kind == BASE else [*parts.get(name, []), part]
            if self._create(latest.number + 1, json.dumps(parts, indent=1)):
                return latest.number + 1
        raise RuntimeError(f"{PUBLISH_ATTEMPTS} other writers published to {self.folder} first")

    def compact(self, deltas: int = 1) -> int:
        """Fold the deltas of tables that have so many or more into new bases, published at once.

        Deltas that arrive meanwhile stay deltas of the new base.
        """
        seen = self.snapshot()
        folded = {name: (parts, self.write(seen.read(self.tables[name]), self.tables[name]))
                  for name, parts in seen.parts.items() if len(parts) > max(deltas, 1)}
        for _ in range(PUBLISH_ATTEMPTS if folded else 0):
            latest = self.snapshot()
            parts = dict(latest.parts)
            for name, (old, base) in folded.items():
                now = parts.get(name, [])
                if now[:len(old)] == old:  # else the table was rebuilt meanwhile
                    parts[name] = [base, *now[len(old):]]
            if self._create(latest.number + 1, json.dumps(parts, indent=1)):
                return latest.number + 1
        return seen.number

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove the parts that none of the last ``keep`` versions names, and older versions.

        Call it when no run is writing: parts that are not published yet look like those of a failed run.
        """
        numbers = self.versions()
        kept = numbers[-max(keep, 1):]
        named = {part for number in kept for parts in self.snapshot(number).parts.values() for part in parts}
        removed = []
        for number in numbers[:-len(kept)] if kept else []:
            self._remove(self._version_file(number))
        for table in self.tables:
            for status in self._list(table.lower()):
                part = f"{table.lower()}/{status.getPath().getName()}"
                if part not in named:
                    self._remove(f"{self.folder}/{part}")
                    removed.append(part)
        return removed

    # ------------------------------------------------------------ files

    def _version_file(self, number: int) -> str:
        return f"{self.folder}/{VERSIONS}/{number:09d}.json"

    def _place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, name: str) -> list:
        place, files = self._place(f"{self.folder}/{name}")
        return list(files.listStatus(place)) if files.exists(place) else []

    def _load(self, path: str) -> str:
        place, files = self._place(path)
        stream = files.open(place)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, number: int, text: str) -> bool:
        """Write a version's file in one step; False if that version exists."""
        aside, files = self._place(f"{self.folder}/{VERSIONS}/_{uuid.uuid4().hex}")
        stream = files.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        final, _ = self._place(self._version_file(number))
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
        no_overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(files.makeQualified(aside), files.makeQualified(final), no_overwrite)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            files.delete(aside, False)
            return False
        return True

    def _remove(self, path: str) -> None:
        place, files = self._place(path)
        files.delete(place, True)


def _partitioned(df: DataFrame, table: ReportTable):
    if PARTITION not in table.key:
        return df.write
    # rebalance: few files per date, and a date with most of the rows is still split
    return df.hint("rebalance", PARTITION).write.partitionBy(PARTITION)
