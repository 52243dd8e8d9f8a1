"""Joins against reference data.

Reference tables and lists are broadcast up to a checked size and shuffled beyond it.
The fact table stays on the left, the side on which AQE can split a hot key for every
join type used here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window, functions as F

from ledgerloom.session import broadcast_if_small, is_small

APART = "_apart"


def apart(df: DataFrame, *keys: str) -> GroupedData:
    """Group by keys for a later join on the same keys; drop column ``APART`` afterwards.

    AQE splits a hot key only where both sides of a join are read from a shuffle made
    for it. Plain grouping leaves its result distributed by the join key, and Spark
    would skip that shuffle; the extra grouping column, a function of the keys, keeps it.
    """
    return df.groupBy(*keys, F.xxhash64(*keys).alias(APART))


def lookup(df: DataFrame, dimension: DataFrame, on: str | list[str],
           defaults: dict[str, object]) -> DataFrame:
    """Left join on ``on``; the attributes in ``defaults`` get that value on a miss.

    ``dimension`` is reduced to the key and the attributes named in ``defaults``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    reference = broadcast_if_small(dimension.select(*keys, *defaults))
    joined = df.join(reference, keys, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(value)) for c, value in defaults.items()
         if value is not None}
    )


def enrich(df: DataFrame, dimension: DataFrame, key: str, *attributes: str) -> DataFrame:
    """Inner join on ``key``: rows without an entry go, the others get the attributes."""
    return df.join(broadcast_if_small(dimension.select(key, *attributes)), key)


def keep_listed(df: DataFrame, listed: DataFrame, key: str, listed_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in the list, which may hold duplicates."""
    return _by_presence(df, listed, key, listed_key, "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, key: str, listed_key: str | None = None) -> DataFrame:
    """Rows whose key does not occur in the list."""
    return _by_presence(df, listed, key, listed_key, "left_anti")


def _by_presence(df, listed, key, listed_key, how):
    members = listed.select(F.col(listed_key or key).alias(key))
    if is_small(members):
        return df.join(F.broadcast(members), key, how)
    # a key listed many times is combined before the shuffle; see apart() for the hash
    distinct = members.withColumn(APART, F.xxhash64(key)).distinct().drop(APART)
    return df.join(distinct, key, how)


def flag_listed(df: DataFrame, listed: DataFrame, key: str, flag: str,
                listed_key: str | None = None) -> DataFrame:
    """Boolean column: does the key occur in the list?"""
    members = apart(listed.select(F.col(listed_key or key).alias(key)), key).agg(
        F.lit(True).alias(flag)).drop(APART)
    marked = df.join(broadcast_if_small(members), key, "left")
    return marked.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def within(day: Column, start: Column, end: Column, closed: str = "both") -> Column:
    """Does the day lie in the interval? ``closed`` is 'both' or 'neither'."""
    if closed == "both":
        return (day >= start) & (day <= end)
    if closed == "neither":
        return (day > start) & (day < end)
    raise ValueError(f"closed must be 'both' or 'neither', not {closed!r}")


# Up to so many boundaries are compared one by one; more are searched by halving.
FEW_BOUNDS = 8
# Halving steps for as many days as dates have.
_STEPS = [1 << i for i in reversed(range(23))]


def validity_bounds(dimension: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, _bounds): the days on which a key becomes valid and stops being so, in turn, in order.

    A key is valid strictly inside any of its intervals. An interval opens on the day after its start
    and closes on its end; openings less closings are summed per key and day, so the sweep sees
    at most one row for each calendar day of a key, and the array has no more, however many intervals
    overlap or touch.
    """
    spans = dimension.where((F.date_add(start, 1) < F.col(end)) & F.col(key).isNotNull())
    steps = F.explode(F.array(
        F.struct(F.date_add(start, 1).alias("day"), F.lit(1).alias("step")),
        F.struct(F.col(end).cast("date").alias("day"), F.lit(-1).alias("step")))).alias("at")
    daily = spans.select(key, steps).groupBy(key, F.col("at.day").alias("day")).agg(F.sum("at.step").alias("step"))
    so_far = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = daily.withColumn("open", F.sum("step").over(so_far))
    turns = swept.where((F.col("open") == 0) != (F.col("open") == F.col("step")))
    return apart(turns, key).agg(F.sort_array(F.collect_list("day")).alias("_bounds")).drop(APART)


def _bounds_before(bounds: Column, day: Column) -> Column:
    """How many of the ordered bounds are on or before the day."""
    few = F.size(F.filter(bounds, lambda b: b <= day))
    halved = F.aggregate(
        F.lit(_STEPS), F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(bounds, at + step - 1) <= day, F.lit(False)), at + step).otherwise(at))
    return F.when(F.size(bounds) <= FEW_BOUNDS, few).otherwise(halved)


def valid_attribute(df: DataFrame, dimension: DataFrame, key: str, day: str, attribute: str,
                    default: str, start: str = "efctv_from_dt", end: str = "efctv_to_dt") -> DataFrame:
    """Attribute of a key, shown only on days strictly inside one of its intervals. Days are dates.

    The intervals of a key become one ordered list of the days on which its validity turns. A row
    is valid after an odd number of turns, which is found by halving, not by a look at each.
    """
    bounds = validity_bounds(dimension, key, start, end)
    named = apart(dimension, key).agg(F.min(attribute).alias(attribute)).drop(APART)
    joined = df.join(broadcast_if_small(named.join(broadcast_if_small(bounds), key)), key, "left")
    valid = _bounds_before(F.col("_bounds"), F.col(day).cast("date")) % 2 == 1
    return joined.withColumn(
        attribute, F.when(F.col("_bounds").isNotNull() & valid, F.col(attribute)).otherwise(default)
    ).drop("_bounds")


def one_per_key(dimension: DataFrame, *keys: str) -> DataFrame:
    """One row per key. Of several rows the greatest is kept, by column order."""
    others = [c for c in dimension.columns if c not in keys]
    picked = apart(dimension, *keys).agg(F.max(F.struct(*others)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def last_per_key(rows: DataFrame, *keys: str, position: str) -> DataFrame:
    """One row per key: of several rows the one with the greatest position, which is unique in its key.

    The greatest position is a hash aggregation over numbers; whole rows are neither sorted nor
    gathered. They are then kept by their position, so a hot key costs one listed row.
    """
    last = apart(rows, *keys).agg(F.max(position).alias(position)).drop(APART)
    last = F.broadcast(last) if is_small(last) else last.hint("shuffle_hash")
    own = [F.col(f"_rows.{c}").eqNullSafe(F.col(f"_last.{c}")) for c in (*keys, position)]
    return rows.alias("_rows").join(last.alias("_last"), own, "left_semi").drop(position)


def with_root(members: DataFrame, key: str = "unq_id", code: str = "member_cd",
              root_code: str = "rt_member_cd", default: str = "None") -> DataFrame:
    """Add ``root_id``, the key of the root member that the root code names.

    A root is a member whose root code is empty or its own code; it is its own root.
    """
    no_root = F.col(root_code).isNull() | (F.col(root_code).cast("string") == "")
    is_root = no_root | (F.col(root_code) == F.col(code))
    roots = one_per_key(
        members.where(is_root).select(F.col(code).alias("_root_code"), F.col(key).alias("root_id")),
        "_root_code",
    )
    coded = members.withColumn(
        "_root_code", F.when(is_root, F.col(code)).otherwise(F.col(root_code))
    )
    return lookup(coded, roots, "_root_code", {"root_id": default}).drop("_root_code")
