"""Shared parts of the command line jobs."""

from __future__ import annotations

import argparse
import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.operators.grouping import REPORT, of_report
from ledgerloom.operators.quality import Watch
from ledgerloom.session import shared_folder, tune
from ledgerloom.sources.feeds import KEPT, read_lines
from ledgerloom.sources.intake import REJECT_COLUMNS, Intake, taken_in
from ledgerloom.sources.sinks import remove, stage
from ledgerloom.sources.store import BASE, DELTA, Store
from ledgerloom.sources.tables import REPORT_TABLES


class Run:
    """One run: where it writes reports and stages shared relations.

    Feeds are parsed once, into good rows and rejects. Staged relations go to the cluster's shared
    checkpoint folder where one is set, else below the output folder; each run has a folder of its
    own there, which ``close`` removes. Reports become visible together when the run is
    published: new tables, or with ``upsert`` the rows that replace those with the same keys.
    """

    def __init__(self, spark: SparkSession, output: str, upsert: bool = False, counts: bool = False):
        self.spark, self.output, self.upsert = spark, output.rstrip("/"), upsert
        folder = shared_folder(spark, f"{self.output}/_stage")
        self.work = f"{folder.rstrip('/')}/run-{uuid.uuid4().hex}"
        self.store = Store(spark, self.output)
        self.parts: dict[str, tuple[str, str]] = {}
        self.counts = counts

    def feeds(self, feed_folder: str, layouts, job: str) -> dict[str, DataFrame]:
        """Staged rows of each feed; its rejects go to ``<output>/<job>/rejects``."""
        paths = feed_paths(feed_folder, layouts)
        prepare(self.spark, paths)
        taken = {feed.name: taken_in(self.spark, paths[feed.name], feed, f"{self.work}/{job}/feeds/{feed.name}")
                 for feed in layouts}
        write_rejects(taken, f"{self.output}/{job}")
        if self.counts:
            write_load_counts(self.spark, taken, f"{self.output}/{job}")
        return {name: feed.rows for name, feed in taken.items()}

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, f"{self.work}/{name}")

    def stage_inputs(self, inputs, job: str, *names: str):
        """Inputs with the named frames staged: many reports look them up."""
        staged = {name: self.stage(getattr(inputs, name), f"{job}/inputs/{name}") for name in names}
        return replace(inputs, **staged)

    def write(self, reports: dict, relation: DataFrame, inputs) -> None:
        for name, build in reports.items():
            part = self.store.write(build(relation, inputs), REPORT_TABLES[name])
            self.parts[name] = (DELTA if self.upsert else BASE, part)

    def watch(self) -> Watch | None:
        """Counters for a job to take as it writes, where the run is to count."""
        return Watch() if self.counts else None

    def write_routed(self, reports: dict, sets: dict, measures: list[str], routed: DataFrame, inputs, name: str) -> None:
        """Reports from sums that were made in one pass: each reads the rows routed to it."""
        path = f"{self.work}/{name}"
        routed.write.partitionBy(REPORT).parquet(path)
        staged = self.spark.read.schema(routed.schema).parquet(path)
        for report, build in reports.items():
            self.write({report: build}, of_report(staged, report, sets[report], measures), inputs)

    def write_misses(self, job: str, watch: Watch) -> None:
        write_counters(self.spark, watch.values(), "counter", "misses", f"{self.output}/{job}/lookup_misses")

    def publish(self) -> int:
        """Show all reports of the run at once."""
        return self.store.publish(self.parts)

    def close(self) -> None:
        """Remove the staged relations; a run that fails leaves them for inspection."""
        remove(self.spark, self.work)


def feed_paths(folder: str, feeds) -> dict[str, str]:
    """Feed name to path: ``<folder>/<name>.csv``, a file or a folder of files."""
    return {feed.name: f"{folder.rstrip('/')}/{feed.name}.csv" for feed in feeds}


def prepare(spark: SparkSession, paths: dict[str, str]) -> None:
    """Size the session for the feed files."""
    tune(spark, *[read_lines(spark, path) for path in paths.values()])


def write_rejects(taken: dict[str, Intake], folder: str) -> None:
    """One row for each rejected line: feed, reason, place and the line."""
    found = [feed.rejects.select(F.lit(name).alias("feed"), *REJECT_COLUMNS) for name, feed in taken.items()]
    reduce(DataFrame.unionByName, found).write.mode("overwrite").parquet(f"{folder}/rejects")


def write_load_counts(spark: SparkSession, taken: dict[str, Intake], folder: str) -> None:
    """Rows loaded per feed, as counted when it was staged."""
    loaded = {name: feed.counts[KEPT] for name, feed in taken.items()}
    write_counters(spark, loaded, "feed", "n_rows", f"{folder}/load_counts")


def write_counters(spark: SparkSession, values: dict, name: str, value: str, path: str) -> None:
    rows = spark.createDataFrame(list(values.items()), f"{name} string, {value} bigint")
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def parser(description: str) -> argparse.ArgumentParser:
    result = argparse.ArgumentParser(description=description)
    result.add_argument("input", help="folder (or file) with the input")
    result.add_argument("output", help="folder for the result")
    return result


def report_parser(description: str) -> argparse.ArgumentParser:
    result = parser(description)
    result.add_argument("--upsert", action="store_true",
                        help="insert or replace rows by key in report tables that exist already")
    result.add_argument("--counts", action="store_true",
                        help="also write rows loaded per feed and misses per lookup")
    return result


def session(name: str) -> SparkSession:
    return SparkSession.builder.appName(name).getOrCreate()
