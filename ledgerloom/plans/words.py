"""Word count and the event samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.text import has_words, lines_of, words_of
from ledgerloom.operators.expansion import split_event


def text_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    # explode_outer: explode would filter on the array's size and so split each text twice
    return documents.where(F.length(text) > 0).select(
        F.explode_outer(lines_of(F.col(text))).alias("value"))


def word_count(lines: DataFrame, value: str = "value") -> DataFrame:
    line = F.col(value)
    words = lines.where(has_words(line)).select(F.explode_outer(words_of(line)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def as_text(counts: DataFrame) -> DataFrame:
    """One text line per word, ready for a text sink."""
    return counts.select(F.concat(F.lit("("), "word", F.lit(","), "n", F.lit(")")).alias("value"))


def expand_events(lines: DataFrame, event: str, value: str = "value") -> DataFrame:
    return lines.select(F.explode_outer(split_event(F.col(value), event)).alias("value"))


def expansion_counts(lines: DataFrame, event: str, value: str = "value") -> DataFrame:
    """Number of lines before and after the expansion, from one scan."""
    return lines.agg(
        F.count(F.lit(1)).alias("n_before"),
        F.coalesce(F.sum(F.size(split_event(F.col(value), event))), F.lit(0))
        .cast("bigint").alias("n_after"),
    )
