"""Operators that turn one row into several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import labels

# How a member takes part under its root; the three kinds do not overlap.
OWN = "own"
PRODUCT = "product"
FUND = "fund"


def member_kind(member: Column, root: Column, is_fund: Column) -> Column:
    return F.when(member == root, OWN).when(is_fund, FUND).otherwise(PRODUCT)


def join_types(kind: Column) -> Column:
    """Report groups a kind counts in. The groups overlap: do not add them up."""
    return (
        F.when(kind == OWN, _labels(labels.TOTAL, labels.OWN_ACCOUNT))
        .when(kind == PRODUCT, _labels(labels.TOTAL, labels.PRODUCT))
        .otherwise(_labels(labels.TOTAL, labels.PRODUCT, labels.MONEY_FUND))
    )


def _labels(*names: str) -> Column:
    return F.array(*[F.lit(n) for n in names])


def expand_join_types(df: DataFrame, kind: str = "kind") -> DataFrame:
    """One row per report group; apply it to aggregated rows, not to single deals."""
    return df.withColumn("join_type", F.explode(join_types(F.col(kind)))).drop(kind)


def legs(deals: DataFrame, sides: dict[str, tuple[str, str]], keep: list[str],
         own: list[str], other: list[str] = ()) -> DataFrame:
    """Two rows per deal, one for each side, in one pass over the deals.

    ``sides`` maps a side name to the column prefixes (own party, other party). The
    ``own`` columns come out without prefix, the ``other`` ones with ``cp_``.
    """
    def leg(side, mine, theirs):
        return F.struct(
            F.lit(side).alias("side"),
            *[F.col(f"{mine}_{c}").alias(c) for c in own],
            *[F.col(f"{theirs}_{c}").alias(f"cp_{c}") for c in other],
        )

    both = F.array(*[leg(side, *prefixes) for side, prefixes in sides.items()])
    return deals.select(*keep, F.inline(both))


def split_event(line: Column, event: str) -> Column:
    """Lines an event line stands for: two logins for the event, else the line itself."""
    fields = F.split(line, ",", -1)
    login = F.concat(F.get(fields, F.lit(0)), F.lit(" login "), F.get(fields, F.lit(2)))
    return F.when(F.get(fields, F.lit(1)) == event, F.array(login, login)).otherwise(F.array(line))
