"""Places of pattern matches in texts, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

BEFORE, AFTER = 40, 24
# Matches whose lengths are summed as one when places are computed.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _long(n) -> Column:
    return F.lit(n).cast("long")


def spans(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` (without capturing groups), leftmost first, not overlapping.

    An array of structs: start and end in characters (end exclusive), value, and the text up to
    ``BEFORE`` characters before and ``AFTER`` behind it, but not across another match. The places
    come from the lengths of the matches and of the pieces between them, summed in blocks, so
    that a text with many matches does not cost their square.
    """
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"),
                     F.split(text, pattern, -1).alias("pieces"))

    def sized(f: Column) -> Column:
        return F.transform(f["values"], lambda v, i: F.struct(
            v.alias("value"), F.length(v).cast("long").alias("own"),
            F.length(F.get(f["pieces"], i)).cast("long").alias("gap"),
            F.right(F.get(f["pieces"], i), F.lit(BEFORE)).alias("before"),
            F.left(F.get(f["pieces"], i + 1), F.lit(AFTER)).alias("after")))

    def total(items: Column) -> Column:
        return F.aggregate(items, _long(0), lambda n, x: n + x["own"] + x["gap"])

    def block_starts(items: Column) -> Column:
        last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                           lambda b: total(F.slice(items, b * BLOCK + 1, BLOCK)))
        return F.aggregate(sums, F.array(_long(0)), lambda out, n: F.array_append(out, F.element_at(out, -1) + n))

    def placed(both: Column) -> Column:
        items, starts = both["items"], both["starts"]

        def one(x: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            start = F.get(starts, block) + total(F.slice(items, block * BLOCK + 1, i - block * BLOCK)) + x["gap"]
            return F.struct(start.alias("start"), (start + x["own"]).alias("end"), x["value"].alias("value"),
                            x["before"].alias("before"), x["after"].alias("after"))

        return F.transform(items, one)

    return let(let(found, sized), lambda items: let(
        F.struct(items.alias("items"), block_starts(items).alias("starts")), placed))


# Up to so many places are compared one by one; more are searched by halving.
FEW = 8
_STEPS = [1 << i for i in reversed(range(24))]


def first_behind(places: Column, start: Column) -> Column:
    """Of structs (start, end) that are in order and do not overlap, the first that ends behind ``start``."""
    few = F.size(F.filter(places, lambda x: x["end"] <= start))
    halved = F.aggregate(
        F.lit(_STEPS), F.lit(0), lambda at, step: F.when(
            F.coalesce(F.get(places, at + step - 1)["end"] <= start, F.lit(False)), at + step).otherwise(at))
    return F.get(places, F.when(F.size(places) <= FEW, few).otherwise(halved))
