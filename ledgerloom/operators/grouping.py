"""Several groupings of one relation in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

REPORT = "_report"


def regroup(df: DataFrame, sets: dict[str, list[str]], measures: list[str]) -> DataFrame:
    """Sums of the measures by each set of columns; ``REPORT`` names the set a row belongs to.

    The relation is read once and its rows are expanded into the sets within the map side of one
    aggregation. Columns outside a row's set are null. Sets must differ.
    """
    columns = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    if len({frozenset(keys) for keys in sets.values()}) < len(sets):
        raise ValueError("two sets have the same columns")
    grouped = df.groupingSets([[F.col(c) for c in keys] for keys in sets.values()], *columns).agg(
        F.grouping_id(*columns).alias(REPORT), *[F.sum(m).alias(m) for m in measures])
    return grouped.withColumn(REPORT, _name(sets, columns))


def _name(sets: dict[str, list[str]], columns: list[str]) -> Column:
    """The set of a grouping id: a bit for each column, set where the row is not grouped by it."""
    ids = {name: sum((c not in keys) << i for i, c in enumerate(reversed(columns))) for name, keys in sets.items()}
    return reduce(lambda case, item: case.when(F.col(REPORT) == item[1], item[0]), ids.items(), F).otherwise(None)


def of_report(routed: DataFrame, name: str, keys: list[str], measures: list[str]) -> DataFrame:
    """The rows of one set, with its columns only."""
    return routed.where(F.col(REPORT) == name).select(*keys, *measures)
