"""Parametric market report and the trading days to compare it with.

Trades have deal_dt, org_nm, player_type, bond_type, amount, deal_nmbr, bond_id.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.labels import ALL_VALUES
from ledgerloom.operators.merging import merge_partial_rows


@dataclass(frozen=True)
class MarketQuery:
    """Report parameters; an empty organisation and 全部 stand for no restriction."""

    begin: date
    end: date
    org: str | None = None
    player_type: str = ALL_VALUES
    bond_type: str = ALL_VALUES


def in_range(query: MarketQuery) -> Column:
    return F.col("deal_dt").between(F.lit(query.begin), F.lit(query.end))


def matches(query: MarketQuery) -> Column:
    """Predicate for the parameters that are set."""
    wanted = F.lit(True)
    if query.org:
        wanted = wanted & (F.col("org_nm") == query.org)
    if query.player_type != ALL_VALUES:
        wanted = wanted & (F.col("player_type") == query.player_type)
    if query.bond_type != ALL_VALUES:
        wanted = wanted & (F.col("bond_type") == query.bond_type)
    return wanted


def matching_trades(trades: DataFrame, query: MarketQuery) -> DataFrame:
    return trades.where(in_range(query) & matches(query))


def preview(trades: DataFrame, query: MarketQuery, rows: int = 14) -> DataFrame:
    """First matching trades, by date and deal number."""
    return matching_trades(trades, query).orderBy("deal_dt", "deal_nmbr").limit(rows)


def market_report(trades: DataFrame, query: MarketQuery) -> DataFrame:
    """One row of totals; ``work_days`` counts all trading days of the range.

    One scan: the range restricts all measures, the other parameters all but
    ``work_days``. Without matching trades the amount and the counts are 0.
    """
    wanted = matches(query)
    return trades.where(in_range(query)).agg(
        F.coalesce(F.sum(F.when(wanted, F.col("amount"))), F.lit(0)).alias("trade_amount"),
        F.count_if(wanted).alias("deal_count"),
        F.count_distinct(F.when(wanted, F.col("deal_dt"))).alias("deal_days"),
        F.count_distinct(F.when(wanted, F.col("org_nm"))).alias("dealer_count"),
        F.count_distinct(F.when(wanted, F.col("bond_id"))).alias("bond_count"),
        F.count_distinct("deal_dt").alias("work_days"),
    )


# ---------------------------------------------------------------- totals that add up over days

DAILY_KEYS = ["deal_dt", "org_nm", "player_type", "bond_type"]
COUNTED = ("org_nm", "bond_id")
# Parts in which values are numbered, and bits of one of Spark's bitmaps.
VALUE_PARTS, BITMAP_BITS = 256, 32_768


def _named_values(trades: DataFrame, *keys: str) -> DataFrame:
    """Distinct (keys, attribute, value) of the counted attributes."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in COUNTED])).alias("pair")
    return trades.select(*keys, pairs).select(*keys, "pair.*").where(F.col("value").isNotNull()).distinct()


def number_values(trades: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Dictionary of the counted attributes: attribute, value and its number. Stage the result.

    ``known`` is the dictionary of earlier days; its values keep their numbers, so bitmaps of different
    days may be united. Values are numbered in 256 parts, which take turns, so no task sees all of them.
    """
    fresh = _named_values(trades)
    if known is not None:
        fresh = fresh.join(known, ["attribute", "value"], "left_anti")
    fresh = fresh.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(VALUE_PARTS)))
    rank = F.row_number().over(Window.partitionBy("attribute", "part").orderBy("value")).cast("bigint") - 1
    if known is None:
        return fresh.select("attribute", "value", (rank * VALUE_PARTS + F.col("part")).alias("number"))
    used = known.groupBy("attribute", F.pmod("number", F.lit(VALUE_PARTS)).alias("part")).agg(
        (F.max("number") - F.col("part") + VALUE_PARTS).alias("used"))
    numbered = fresh.withColumn("rank", rank).join(used, ["attribute", "part"], "left").select(
        "attribute", "value",
        (F.coalesce("used", F.lit(0)) + F.col("rank") * VALUE_PARTS + F.col("part")).alias("number"))
    return known.select("attribute", "value", "number").unionAll(numbered)


def daily_sums(trades: DataFrame) -> DataFrame:
    """Amount and number of deals by ``DAILY_KEYS``."""
    return trades.groupBy(*DAILY_KEYS).agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("deals"))


def daily_bitmaps(trades: DataFrame, numbers: DataFrame) -> DataFrame:
    """The numbered values that a day's trades name, as bitmaps: ``DAILY_KEYS``, attribute, bucket, bits.

    Values are made distinct per day before their numbers are looked up.
    """
    numbered = _named_values(trades, *DAILY_KEYS).join(numbers, ["attribute", "value"])
    return numbered.groupBy(*DAILY_KEYS, "attribute", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def market_report_of_days(sums: DataFrame, bitmaps: DataFrame, query: MarketQuery) -> DataFrame:
    """``market_report`` from the totals of days: bitmaps are united over the range and their bits counted.

    Trades are not read, and nothing is counted by expanding rows. Days are bits as they are: the
    days since the range began.
    """
    wanted = matches(query)
    at = F.datediff(F.col("deal_dt"), F.lit(query.begin)).cast("bigint")

    def days(condition: Column) -> Column:
        return F.bitmap_count(F.bitmap_construct_agg(F.when(condition, F.pmod(at, F.lit(BITMAP_BITS)))))

    by_calendar = sums.where(in_range(query)).groupBy(F.floor(at / BITMAP_BITS).alias("bucket")).agg(
        F.sum(F.when(wanted, F.col("amount"))).alias("trade_amount"),
        F.sum(F.when(wanted, F.col("deals"))).alias("deal_count"),
        days(wanted).alias("deal_days"), days(F.lit(True)).alias("work_days"))
    united = bitmaps.where(in_range(query) & wanted).groupBy("attribute", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    counted = [F.sum(F.when(F.col("attribute") == c, F.col("n"))).alias(name)
               for c, name in zip(COUNTED, ("dealer_count", "bond_count"))]
    totals = by_calendar.agg(*[F.sum(c).alias(c) for c in ("trade_amount", "deal_count", "deal_days", "work_days")])
    row = merge_partial_rows([], totals, united.agg(*counted))
    columns = ("trade_amount", "deal_count", "deal_days", "dealer_count", "bond_count", "work_days")
    return row.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns])


def trading_days(trades: DataFrame) -> DataFrame:
    return trades.select("deal_dt").distinct()


def comparison_days(trades: DataFrame, query: MarketQuery) -> DataFrame:
    """The last N trading days before the range, N being its number of trading days.

    The window runs over distinct days, which the calendar bounds; N stays a column.
    """
    days = trading_days(trades.where(F.col("deal_dt") <= F.lit(query.end)))
    before = F.col("deal_dt") < F.lit(query.begin)
    everything = Window.partitionBy()
    newest_first = Window.partitionBy("_before").orderBy(F.col("deal_dt").desc())
    ranked = (
        days.withColumn("_before", before)
        .withColumn("_n", F.count_if(~before).over(everything))
        .withColumn("day_rank", F.row_number().over(newest_first))
    )
    return ranked.where(F.col("_before") & (F.col("day_rank") <= F.col("_n"))).select(
        "day_rank", "deal_dt"
    )
