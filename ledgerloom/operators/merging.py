"""Keyed merges that stand in for row-by-row upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerloom.operators.lookups import APART, apart


def upsert(existing: DataFrame, arriving: DataFrame, keys: list[str]) -> DataFrame:
    """Arriving rows replace existing rows with the same key; other rows stay."""
    kept = existing.join(arriving.select(*keys), keys, "left_anti")
    return kept.unionByName(arriving)


def merge_partial_rows(keys: list[str], *parts: DataFrame) -> DataFrame:
    """Assemble rows whose measure columns come from several frames.

    Each part has unique keys and its own measures. A union with one grouped
    aggregation needs a single shuffle, and AQE has no full outer join to split.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    measures = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])


def append_families(*families: DataFrame) -> DataFrame:
    """Append row families that share a schema and differ in a key column."""
    return reduce(lambda a, b: a.unionByName(b), families)


def share_of_total(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Add ``<value>_total``, the group total, to every row.

    A window would gather a whole group in one task; the grouped total is
    pre-aggregated before its shuffle, and the join back can be split by AQE.
    """
    totals = apart(df, *keys).agg(F.sum(value).alias(f"{value}_total")).drop(APART)
    return df.join(totals, keys, "inner")
