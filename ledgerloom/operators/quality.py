"""Load counts and lookup-miss counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ledgerloom.operators.grouping import REPORT, regroup
from ledgerloom.session import broadcast_if_small


def load_counts(feeds: dict[str, DataFrame]) -> DataFrame:
    """One row per feed with the number of rows it loaded."""
    return _stack([
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("feed"), "n_rows")
        for name, df in feeds.items()
    ])


def misses(df: DataFrame, dimension: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Number of rows whose key is not in the dimension, as one row.

    ``keys`` maps columns of ``df`` to columns of ``dimension``. Rows are counted per
    key before the join, so a hot key is one row by then.
    """
    names = list(keys)
    per_key = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    known = dimension.select(*[F.col(d).alias(c) for c, d in keys.items()])
    unknown = per_key.join(known, names, "left_anti")
    return unknown.agg(F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("misses"))


def miss_report(counters: dict[str, DataFrame]) -> DataFrame:
    """Stack one-row miss counts into one frame."""
    return _stack([
        df.select(F.lit(name).alias("counter"), "misses") for name, df in counters.items()
    ])


def misses_at_once(rows: DataFrame, counted: Column, lookups: dict[str, tuple[DataFrame, dict[str, str]]],
                   conditions: dict[str, Column]) -> DataFrame:
    """Several counters over one relation, which is read once: (counter, misses).

    Of the ``counted`` rows those without an entry in each dimension, and of all rows those that meet
    each condition. Rows are counted per key of every lookup in one aggregation; only these counts meet
    the dimensions. The lookups need different columns.
    """
    numbers = {f"_n{i}": condition for i, condition in enumerate([counted, *conditions.values()])}
    columns = list(dict.fromkeys(c for _, keys in lookups.values() for c in keys))
    marked = regroup(
        rows.select(*columns, *[F.when(c, 1).otherwise(0).alias(n) for n, c in numbers.items()]),
        {name: list(keys) for name, (_, keys) in lookups.items()}, list(numbers))
    for name, (dimension, keys) in lookups.items():
        renamed = {c: f"_{name}_{c}" for c in keys}
        known = dimension.select(*[F.col(d).alias(renamed[c]) for c, d in keys.items()]).distinct().withColumn(
            f"_{name}", F.lit(True))
        same = reduce(lambda a, b: a & b, [F.col(c) == F.col(new) for c, new in renamed.items()])
        marked = marked.join(broadcast_if_small(known), same & (F.col(REPORT) == name), "left").drop(*renamed.values())

    def total(number, where):
        return F.coalesce(F.sum(F.when(where, F.col(number))), F.lit(0).cast("bigint"))

    first = F.col(REPORT) == next(iter(lookups))        # its groups hold each row once
    sums = marked.agg(
        *[total("_n0", (F.col(REPORT) == name) & F.col(f"_{name}").isNull()).alias(name) for name in lookups],
        *[total(number, first).alias(name) for name, number in zip(conditions, list(numbers)[1:])])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("counter"), F.col(name).alias("misses")) for name in sums.columns])))


class Watch:
    """Counters taken while a run writes its relations, without a job of their own.

    Each method returns the same rows, to be written once. A counter is known when they are; it is
    null if they were not. A stage that Spark runs again after the loss of an executor may be counted
    again in a relation behind a shuffle: counters tell of data quality and decide nothing.
    """

    def __init__(self):
        self._seen: list[tuple[Observation, list[str]]] = []

    def rows(self, df: DataFrame, **conditions: Column) -> DataFrame:
        """Count the rows that meet each condition."""
        observation = Observation()
        self._seen.append((observation, list(conditions)))
        return df.observe(observation, *[F.count_if(c).alias(name) for name, c in conditions.items()])

    def misses(self, df: DataFrame, where: Column | None = None,
               **lookups: tuple[DataFrame, dict[str, str]]) -> DataFrame:
        """Count the rows without an entry in each dimension (of those that meet ``where``).

        Dimensions are reduced to their distinct keys, and broadcast up to the checked size.
        """
        marked, columns = df, df.columns
        for name, (dimension, keys) in lookups.items():
            renamed = {c: f"_{name}_{c}" for c in keys}
            known = dimension.select(*[F.col(d).alias(renamed[c]) for c, d in keys.items()]).distinct().withColumn(
                f"_{name}", F.lit(True))
            same = reduce(lambda a, b: a & b, [F.col(c) == F.col(new) for c, new in renamed.items()])
            marked = marked.join(broadcast_if_small(known), same, "left").drop(*renamed.values())
        counted = F.lit(True) if where is None else where
        return self.rows(marked, **{name: counted & F.col(f"_{name}").isNull() for name in lookups}).select(*columns)

    def values(self) -> dict[str, int | None]:
        """The counters, in the order they were set up."""
        found = {}
        for observation, names in self._seen:
            taken = observation.get
            found.update({name: taken.get(name) for name in names})
        return found


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
