"""Text helpers built from Spark's own string functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def lines_of(text: Column) -> Column:
    """Lines of a text that is not empty; the line end after the last line starts no other.

    A line ends with LF, CR or CR LF. Only text with a CR pays for a regular expression.
    """
    unix = F.when(text.contains("\r"), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)
    body = F.when(unix.endswith("\n"), F.left(unix, F.length(unix) - 1)).otherwise(unix)
    return F.split(body, "\n", -1)


def has_words(line: Column) -> Column:
    """A line of blanks alone has no words; an empty line has one empty word."""
    return (F.length(line) == 0) | (F.length(F.rtrim(line)) > 0)


def words_of(line: Column) -> Column:
    """Words of a line that has any: blanks at the end are cut, two in a row hold an empty word."""
    return F.split(F.rtrim(line), " ", -1)


def parse_date(text: Column, pattern: str) -> Column:
    """Date by pattern; null where the text is not a date."""
    return F.try_to_date(text, pattern)


def parse_decimal(text: Column, precision: int, scale: int) -> Column:
    """Decimal; null where the text is not a number."""
    return text.try_cast(f"decimal({precision},{scale})")


def set_text(members: Column) -> Column:
    """Members of an array in order, comma-joined; null for an empty one."""
    return F.when(F.size(members) > 0, F.array_join(F.sort_array(members), ","))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
