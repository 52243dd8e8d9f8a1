"""Scan of quoted comma-separated feeds.

Built from Spark's string functions rather than ``from_csv`` because the feeds keep
doubled quotes as they are, drop text after a closing quote and trim inside quotes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.sources.layouts import FeedLayout

# A field is a run of unquoted text and quoted sections; commas count outside quotes only.
_FIELD = r',([^",]*+(?:"[^"]*+(?:"|$)[^",]*+)*+)'
# The opening quote, and the closing quote with whatever follows it.
_ENCLOSING_QUOTES = r'^"|"[^"]*$'
_BLANKS = " \t\r\n\x0b\x0c"


# How a feed marks its header: the first line of each file, or any line that holds the
# layout's tag. The tags are short and also occur in names, so tags may drop data lines.
FIRST_LINE, TAG = "first line", "tag"

# What becomes of a line.
KEPT = "kept"
EMPTY_LINE, HEADER_LINE, FIELD_COUNT, EMPTY_FIELD = REASONS = ("empty line", "header tag", "field count", "empty field")


def read_lines(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """Lines as column ``value``; with ``FIRST_LINE`` without the first line of each file."""
    if header != FIRST_LINE:
        return spark.read.text(path)
    # a one-column CSV whose separator and quotes never occur: Spark skips the header line
    # of each file, however the file is split
    return (
        spark.read.schema("value string")
        .options(header=True, sep="\x01", quote="", escape="", maxCharsPerColumn=-1,
                 enforceSchema=True, mode="PERMISSIVE")
        .csv(path)
    )


def read_feed(spark: SparkSession, path: str, layout: FeedLayout, header: str = FIRST_LINE) -> DataFrame:
    """Read one feed file (or folder of files) into named text columns."""
    return parse_feed(read_lines(spark, path, header), layout, header=header)


def data_lines(lines: DataFrame, header_tag: str | None, value: str = "value") -> DataFrame:
    """Drop empty lines and, if a tag is given, every line that contains it anywhere."""
    line = F.col(value)
    kept = lines.where(F.length(line) > 0)
    return kept if header_tag is None else kept.where(~line.contains(header_tag))


def parse_feed(lines: DataFrame, layout: FeedLayout, value: str = "value", header: str = TAG) -> DataFrame:
    """Turn text lines into the layout's columns; lines that do not fit are dropped.

    With ``TAG`` lines that hold the header tag are dropped as well. ``rejects`` counts them.
    """
    # explode of a one-element array keeps the split from being evaluated again for
    # the arity filter and for every column
    tag = layout.header_tag if header == TAG else None
    fields = data_lines(lines, tag, value).select(
        F.explode(F.array(split_fields(F.col(value)))).alias("fields")
    )
    width = len(layout.columns)
    if layout.exact_arity:
        fields = fields.where(F.size("fields") == width)
    rows = fields.select(
        *[F.coalesce(F.get("fields", F.lit(i)), F.lit("")).alias(c)
          for i, c in enumerate(layout.columns)]
    )
    return require(rows, layout.required)


def rejects(lines: DataFrame, layout: FeedLayout, value: str = "value", header: str = TAG) -> DataFrame:
    """(reason, n_lines): what ``parse_feed`` drops, and ``kept``. One pass over the lines."""
    line = F.col(value)
    rows = lines.select(line.alias("line"), F.explode(F.array(split_fields(line))).alias("fields"))
    reason = F.coalesce(reject_reason(layout, header), F.lit(KEPT))
    return rows.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n_lines"))


def reject_reason(layout: FeedLayout, header: str = TAG) -> Column:
    """Why a line (columns ``line`` and ``fields``) does not fit the layout; null if it fits."""
    reason = F.when(F.coalesce(F.length("line"), F.lit(0)) == 0, EMPTY_LINE)
    if header == TAG:
        reason = reason.when(F.col("line").contains(layout.header_tag), HEADER_LINE)
    if layout.exact_arity:
        reason = reason.when(F.size("fields") != len(layout.columns), FIELD_COUNT)
    required = [layout.columns.index(c) for c in layout.required]
    if required:
        missing = [F.length(F.coalesce(F.get("fields", F.lit(i)), F.lit(""))) == 0 for i in required]
        reason = reason.when(reduce(lambda a, b: a | b, missing), EMPTY_FIELD)
    return reason


def split_fields(line: Column) -> Column:
    """Array of the trimmed fields of a line; commas inside double quotes do not split."""
    quoted = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1)),
        lambda f: F.regexp_replace(_trim(f), _ENCLOSING_QUOTES, ""),
    )
    plain = F.split(line, ",", -1)
    return F.transform(F.when(line.contains('"'), quoted).otherwise(plain), _trim)


def split_record(lines: DataFrame, columns: tuple[str, ...], value: str = "value") -> DataFrame:
    """Plain comma split into named columns, one row per line; no quotes, no checks."""
    fields = F.split(F.col(value), ",", -1)
    return lines.select(*[F.get(fields, F.lit(i)).alias(c) for i, c in enumerate(columns)])


def require(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Keep rows in which none of the columns is empty."""
    for column in columns:
        df = df.where(F.length(column) > 0)
    return df


def _trim(text: Column) -> Column:
    return F.trim(text, F.lit(_BLANKS))
