"""One scan of each feed: good rows, rejected lines and their counts.

A feed is parsed once. The scan writes what fits the layout and what does not side by side, with the
place of each line, and counts both as they pass; whatever a job does later reads the
staged rows.

``POSITION`` orders the lines of a feed: files by name, lines as they stand in the file. It is one
number, so the last line of a key is found by a hash aggregation:

    file's rank * 2^83 + first byte of the line's split * 2^33 + line's number in its scan task

Within a split lines are numbered as they stand, and splits of a file follow one another by
their first byte, so the order does not depend on which task reads which split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ledgerloom.sources import feeds
from ledgerloom.sources.layouts import FeedLayout

POSITION = "_position"
REJECT_COLUMNS = ("reason", "file", "split_start", "line_in_task", "line")
# Bits of a line's number in a task, as Spark numbers rows, and of a byte's place in a file.
_LINE_BITS, _BYTE_BITS = 33, 50


@dataclass(frozen=True)
class Intake:
    """A staged feed."""

    rows: DataFrame       # the layout's columns, and POSITION
    rejects: DataFrame    # REJECT_COLUMNS of each line that did not fit
    counts: dict[str, int]  # lines by reason, and kept ones; taken while the feed was staged


def scan(spark: SparkSession, path: str, layout: FeedLayout, header: str = feeds.FIRST_LINE) -> DataFrame:
    """Every line of a feed once: POSITION, ``reason`` (null where it fits), the layout's columns of lines that
    fit, and file, split_start, line_in_task and line of those that do not."""
    lines = feeds.read_lines(spark, path, header)
    located = lines.select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"), F.monotonically_increasing_id().alias("_row"))
    parts = _ranked(located, lines.inputFiles()).withColumn(
        "fields", F.explode(F.array(feeds.split_fields(F.col("line")))))
    parts = parts.withColumn("reason", feeds.reject_reason(layout, header))
    in_task = F.col("_row").bitwiseAND(F.lit((1 << _LINE_BITS) - 1))
    fits = F.col("reason").isNull()
    of_reject = {"file": F.col("file"), "split_start": F.col("split_start"), "line_in_task": in_task, "line": F.col("line")}
    return parts.select(
        position(F.col("_rank"), F.col("split_start"), in_task).alias(POSITION), "reason",
        *[F.when(fits, F.coalesce(F.get("fields", F.lit(i)), F.lit(""))).alias(c) for i, c in enumerate(layout.columns)],
        *[F.when(~fits, value).alias(name) for name, value in of_reject.items()])


def position(rank: Column, split_start: Column, in_task: Column) -> Column:
    """The number that orders lines; decimals hold it exactly and are aggregated by hash."""
    def scaled(value: Column, places: int, bits: int) -> Column:
        return value.cast(f"decimal({places},0)") * F.lit(str(1 << bits)).cast(f"decimal({len(str(1 << bits))},0)")

    placed = scaled(rank, 12, _LINE_BITS + _BYTE_BITS) + scaled(split_start, 20, _LINE_BITS) + in_task
    return placed.cast("decimal(38,0)")


# Spark writes the scheme of one file as ``file:/`` here and ``file:///`` there.
_SCHEME, _ONE_SLASH = "^([a-z0-9]+:)/+", "$1/"


def _ranked(lines: DataFrame, files: list[str]) -> DataFrame:
    """Lines with the rank of their file by name; Spark's driver holds the list of files anyway."""
    if len(files) < 2:
        return lines.withColumn("_rank", F.lit(0))
    place = F.regexp_replace("file", _SCHEME, _ONE_SLASH)
    ranks = lines.sparkSession.createDataFrame(list(enumerate(sorted(files))), "_rank long, file string").select(
        "_rank", place.alias("_place"))
    ranked = lines.withColumn("_place", place).join(F.broadcast(ranks), "_place", "left").drop("_place")
    return ranked.withColumn("_rank", F.coalesce("_rank", F.lit(0)))


def taken_in(spark: SparkSession, path: str, layout: FeedLayout, folder: str, header: str = feeds.FIRST_LINE) -> Intake:
    """Scan a feed once into ``folder``, good rows and rejects apart."""
    counted = Observation(layout.name)
    of = {reason: F.count_if(F.col("reason") == reason).alias(reason) for reason in feeds.REASONS}
    found = scan(spark, path, layout, header).observe(
        counted, F.count_if(F.col("reason").isNull()).alias(feeds.KEPT), *of.values())
    found = found.withColumn("kept", F.col("reason").isNull())
    found.write.partitionBy("kept").parquet(folder)
    staged = spark.read.schema(found.schema).parquet(folder)
    return Intake(
        staged.where(F.col("kept")).select(*layout.columns, POSITION),
        staged.where(~F.col("kept")).select(*REJECT_COLUMNS),
        {reason: int(counted.get.get(reason, 0)) for reason in (feeds.KEPT, *feeds.REASONS)})
