"""Bond job: base relations T1, T2, T3 and the nine report tables.

Every report groups by bond, so bond attributes are joined to the aggregated rows
rather than to single deals; that inner join also drops the bonds which are not in
the bond table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import labels
from ledgerloom.functions.measures import ratio, sum_if, weighted_average
from ledgerloom.operators import expansion
from ledgerloom.operators.lookups import (
    drop_listed, enrich, keep_listed, lookup, one_per_key, valid_attribute,
)
from ledgerloom.plans.inputs import BondInputs
from ledgerloom.session import broadcast_if_small

ISSUE_UNIT = 100_000_000
SIDES = {"buy": ("buyer", "seller"), "sell": ("seller", "buyer")}
POSITION_KEYS = ["deal_dt", "bond_id", "org_id"]


def is_normal() -> Column:
    """A deal without an entry in the strategy feed does not count as normal."""
    return F.col("strategy") == labels.NORMAL


# ---------------------------------------------------------------- base relations

def clean_deals(inputs: BondInputs) -> DataFrame:
    """T1 without the looked-up attributes: the valid deals.

    Dropped are withdrawn deals (status compared as text), other currencies, deals
    without a valid date and deals on the removal list.
    """
    return drop_listed(inputs.deals.where(is_kept(inputs)), inputs.removed, "bond_deal_id", "deal_id")


def is_kept(inputs: BondInputs) -> Column:
    """Is a deal clean, apart from the removal list?"""
    currency = F.col("instmt_crncy")
    return ((F.col("st") != inputs.withdrawn) & (currency.contains("CNY") | currency.contains("-"))
            & F.col("deal_dt").isNotNull())


def with_strategy(deals: DataFrame, inputs: BondInputs) -> DataFrame:
    """Strategy label of each deal, for the reports that tell normal trades apart."""
    strategies = inputs.strategies.select(
        "deal_nmbr", labels.strategy_label(F.col("deal_strategy")).alias("strategy")
    )
    return lookup(deals, strategies, "deal_nmbr", {"strategy": labels.MISSING})


def enriched_deals(inputs: BondInputs) -> DataFrame:
    """T1 in full: deals with strategy, bond, custodian, tenor and the types of both parties."""
    deals = with_strategy(clean_deals(inputs), inputs).withColumn("tenor", tenor()).join(
        broadcast_if_small(bond_attributes(inputs).select(
            "bond_id", "bond_cd", "bond_nm", "bond_ctgry_nm2", "cstdn")),
        "bond_id",
    )
    types = one_per_key(inputs.members.select("ip_id", "ins_show_name"), "ip_id")
    for role in ("buyer", "seller"):
        deals = lookup(
            deals,
            types.select(F.col("ip_id").alias(f"{role}_id"),
                         F.col("ins_show_name").alias(f"{role}_type")),
            f"{role}_id",
            {f"{role}_type": labels.MISSING},
        )
    return deals


def deal_count() -> Column:
    """Deals, each counted once however many rows it has."""
    return F.count_distinct("bond_deal_id").alias("deal_cnt")


def tenor() -> Column:
    return labels.tenor_bucket(F.col("yr_of_time_to_mrty"))


def bond_attributes(inputs: BondInputs) -> DataFrame:
    """Bonds with report category and custodian name."""
    orgs = inputs.orgs.select(
        F.col("unq_id").alias("cstdtn_bank_id"), F.col("chn_full_nm").alias("cstdn")
    )
    bonds = inputs.bonds.withColumn("bond_ctgry_nm2", labels.bond_category(F.col("bond_ctgry_nm")))
    return lookup(bonds, orgs, "cstdtn_bank_id", {"cstdn": labels.MISSING})


def positions(deals: DataFrame) -> DataFrame:
    """T2: buy and sell amounts per (date, bond, institution).

    Each deal gives a buy leg and a sell leg; one grouped aggregation then does what
    a full outer join of a buy and a sell aggregate would, with one shuffle.
    """
    def measures(side):
        on_side = F.col("side") == side
        return [
            _or_zero(sum_if(on_side, F.col("dirty_amnt"))).alias(f"{side}_act_all"),
            _or_zero(sum_if(on_side, F.col("face_amnt"))).alias(f"{side}_paper_all"),
        ]

    return _by_position(deals, ["dirty_amnt", "face_amnt"], measures)


def position_yields(deals: DataFrame) -> DataFrame:
    """T2, yields: weighted by trade amount per (date, bond, institution) and side.

    Before cleansing (bf) all trades count, after cleansing (af) normal ones.
    """
    def measures(side):
        on_side = F.col("side") == side
        normal = on_side & is_normal()
        return [
            _or_zero(ratio(sum_if(c, F.col("weighted")), sum_if(c, F.col("trade_amnt")))).alias(name)
            for c, name in ((on_side, f"{side}_ytm_rate_bf"), (normal, f"{side}_ytm_rate_af"))
        ]

    deals = deals.withColumn("weighted", F.col("ytm_rate") * F.col("trade_amnt"))
    return _by_position(deals, ["trade_amnt", "weighted", "strategy"], measures)


def _by_position(deals, columns, measures):
    sided = expansion.legs(deals, SIDES, ["deal_dt", "bond_id", *columns], own=["id"])
    return (
        sided.where(F.col("id").isNotNull())
        .groupBy("deal_dt", "bond_id", F.col("id").alias("org_id"))
        .agg(*[m for side in SIDES for m in measures(side)])
    )


def collateral_rate(repo_deals: DataFrame, collateral: DataFrame) -> DataFrame:
    """T3: conversion ratio per (instrument, date), weighted by the amount of the deal.

    sum(ratio * amount) / sum(amount) over the day's collateral lines, 0 if there are none or
    the amounts add up to 0. A day's rate depends on that day's deals alone.
    """
    lines = collateral.where(F.col("ri_id") != F.lit("0").cast(collateral.schema["ri_id"].dataType))
    daily = (
        lines.select("ri_id", "ev_id", "cnvrsn_prprtn")
        .join(repo_deals.select("ev_id", "deal_dt", "trade_amnt"), "ev_id")
        .groupBy("ri_id", "deal_dt")
        .agg(weighted_average(F.col("cnvrsn_prprtn"), F.col("trade_amnt")).alias("zy_rate"))
    )
    return daily.select("ri_id", "deal_dt", _or_zero(F.col("zy_rate")).alias("zy_rate"))


def _or_zero(measure: Column) -> Column:
    return F.coalesce(measure, F.lit(0))


def _with_bond(report: DataFrame, inputs: BondInputs, *attributes: str) -> DataFrame:
    return enrich(report, inputs.bonds, "bond_id", *attributes)


def _with_show_name(report: DataFrame, inputs: BondInputs) -> DataFrame:
    members = inputs.members.withColumnRenamed("ip_id", "org_id")
    return valid_attribute(report, members, "org_id", "deal_dt", "ins_show_name", labels.MISSING)


# ---------------------------------------------------------------- reports

def xbond_info(deals: DataFrame, inputs: BondInputs) -> DataFrame:
    """XBOND_INFO: bonds traded by anonymous click."""
    methods = inputs.methods.where(F.col("trdng_mthd_blngl_nm").contains(labels.ANONYMOUS_CLICK))
    traded = keep_listed(deals, methods, "trdng_mthd_id").select("bond_id").distinct()
    return _with_bond(traded, inputs, "bond_cd", "bond_nm").groupBy("bond_cd").agg(
        F.min("bond_nm").alias("bond_nm")
    )


def bond_bsc_info(deals: DataFrame, inputs: BondInputs) -> DataFrame:
    """BOND_BSC_INFO: amount, number of deals and turnover per (date, bond).

    The years to maturity are the smallest of the day's deals.
    """
    daily = deals.groupBy("deal_dt", "bond_id").agg(
        F.sum("dirty_amnt").alias("trd_amnt"),
        F.sum("face_amnt").alias("face_sum"),
        deal_count(),
        F.min("yr_of_time_to_mrty").alias("yr_of_time_to_mrty"),
    )
    bonds = bond_attributes(inputs).where(
        F.col("lstng_dt").isNotNull() & F.col("frst_value_dt").isNotNull()
        & F.col("mrty_dt").isNotNull() & F.col("ttl_face_value").isNotNull()
    )
    return daily.join(broadcast_if_small(bonds), "bond_id").select(
        "deal_dt", "bond_id", "bond_cd", "bond_nm", "bond_ctgry_nm", "yr_of_time_to_mrty",
        "frst_value_dt", "mrty_dt", F.col("scnd_blngl_desc").alias("bond_prd"),
        ratio(F.col("ttl_face_value"), F.lit(ISSUE_UNIT)).alias("issue_vlmn"),
        "cstdn", "trd_amnt", "deal_cnt",
        ratio(F.col("face_sum"), F.col("ttl_face_value")).alias("day_turnover_rate"),
    )


def bond_turnover_rate(deals: DataFrame, inputs: BondInputs,
                       rates: DataFrame | None = None) -> DataFrame:
    """BOND_TURNOVER_RATE: turnover per (date, bond, tenor) and over all tenors.

    Only the all-tenor rows carry the collateral rate, 0 where there is none. Tenor rows hold
    the amounts of that tenor, and bonds without face value have no rows; a literal reading of
    the stored tables would put the whole day's amounts on each tenor row.
    """
    rates = rates or inputs.rates
    if rates is None:
        reported = keep_listed(inputs.collateral, inputs.bonds, "ri_id", "bond_id")
        rates = collateral_rate(inputs.repo_deals, reported)
    by_tenor = deals.groupBy("deal_dt", "bond_id", tenor().alias("tenor")).agg(
        F.sum("face_amnt").alias("face_sum"), F.sum("dirty_amnt").alias("trd_amnt_sum")
    )
    both = by_tenor.withColumn(
        "bond_prd", F.explode(F.array(F.lit(labels.ALL_TENORS), F.col("tenor")))
    ).groupBy("deal_dt", "bond_id", "bond_prd").agg(
        F.sum("face_sum").alias("face_sum"), F.sum("trd_amnt_sum").alias("trd_amnt_sum")
    )
    bonds = inputs.bonds.where(F.col("ttl_face_value") != 0).select(
        "bond_id", "bond_cd", "bond_nm", "ttl_face_value",
        labels.bond_category(F.col("bond_ctgry_nm")).alias("bond_ctgry_nm2"),
    )
    rated = both.join(broadcast_if_small(bonds), "bond_id").join(
        rates.withColumnRenamed("ri_id", "bond_id"), ["bond_id", "deal_dt"], "left"
    )
    return rated.select(
        "deal_dt", "bond_id", "bond_prd", "bond_ctgry_nm2", "bond_cd", "bond_nm",
        ratio(F.col("face_sum"), F.col("ttl_face_value")).alias("day_turnover_rate"),
        "trd_amnt_sum",
        F.when(F.col("bond_prd") == labels.ALL_TENORS, _or_zero(F.col("zy_rate"))).alias("zy_rate"),
    )


def bond_income(held: DataFrame, inputs: BondInputs) -> DataFrame:
    """BOND_INCOME: full price and face sums per side."""
    return _with_bond(held, inputs, "bond_cd", "bond_nm").select(
        *POSITION_KEYS, "bond_cd", "bond_nm",
        "buy_paper_all", "buy_act_all", "sell_paper_all", "sell_act_all",
    )


def bond_deal_trend(deals: DataFrame, inputs: BondInputs) -> DataFrame:
    """BOND_DEAL_TREND: yield weighted by full price; bf strategy trades, af normal ones."""
    rate, weight = F.col("ytm_rate"), F.col("dirty_amnt")
    daily = deals.groupBy("deal_dt", "bond_id").agg(
        _or_zero(weighted_average(rate, weight, ~is_normal())).alias("dirty_price_wg_bf"),
        _or_zero(weighted_average(rate, weight, is_normal())).alias("dirty_price_wg_af"),
    )
    return _with_bond(daily, inputs, "bond_cd", "bond_nm").select(
        "deal_dt", "bond_id", "bond_cd", "bond_nm", "dirty_price_wg_bf", "dirty_price_wg_af"
    )


def bond_deal_trend_org(yields: DataFrame, inputs: BondInputs) -> DataFrame:
    """BOND_DEAL_TREND_ORG: buy and sell yields per institution, all and normal trades."""
    named = _with_show_name(_with_bond(yields, inputs, "bond_cd", "bond_nm"), inputs)
    return named.select(
        *POSITION_KEYS, "bond_cd", "bond_nm", "ins_show_name",
        "buy_ytm_rate_bf", "buy_ytm_rate_af", "sell_ytm_rate_bf", "sell_ytm_rate_af",
    )


def bond_deal_orgtype(held: DataFrame, inputs: BondInputs) -> DataFrame:
    """BOND_DEAL_ORGTYPE: traded and net amount per (date, bond, institution type)."""
    by_type = _with_show_name(held, inputs).groupBy("deal_dt", "bond_id", "ins_show_name").agg(
        F.sum(F.col("buy_act_all") + F.col("sell_act_all")).alias("trd_amnt"),
        F.sum(F.col("buy_paper_all") - F.col("sell_paper_all")).alias("net_amnt"),
    )
    return _with_bond(by_type, inputs, "bond_cd", "bond_nm").select(
        "deal_dt", "bond_id", "ins_show_name", "bond_cd", "bond_nm", "trd_amnt", "net_amnt"
    )


def bond_deal_orglist(held: DataFrame, inputs: BondInputs) -> DataFrame:
    """BOND_DEAL_ORGLIST: institutions active in a bond on a day (rows are unique already)."""
    named = _with_show_name(held.select(*POSITION_KEYS), inputs)
    return _with_bond(named, inputs, "bond_ctgry_id", "bond_cd", "bond_nm").select(
        "deal_dt", "bond_id", "bond_ctgry_id", "org_id", "ins_show_name", "bond_cd", "bond_nm"
    )


def bond_deal_smart(deals: DataFrame, inputs: BondInputs) -> DataFrame:
    """BOND_DEAL_SMART: number of normal and of other trades per (date, bond)."""
    daily = deals.groupBy("deal_dt", "bond_id").agg(
        F.count_if(is_normal()).alias("trade_normal"),
        F.count_if(~is_normal()).alias("trade_smart"),
    )
    return _with_bond(daily, inputs, "bond_cd", "bond_nm", "bond_ctgry_nm").select(
        "deal_dt", "bond_id", "bond_cd", "bond_nm",
        labels.bond_category(F.col("bond_ctgry_nm")).alias("bond_ctgry_nm2"),
        "trade_normal", "trade_smart",
    )


# Reports by the relation they start from; deals with strategy serve all of the first.
FROM_DEALS = {
    "XBOND_INFO": xbond_info,
    "BOND_BSC_INFO": bond_bsc_info,
    "BOND_TURNOVER_RATE": bond_turnover_rate,
}
FROM_LABELLED_DEALS = {
    "BOND_DEAL_TREND": bond_deal_trend,
    "BOND_DEAL_SMART": bond_deal_smart,
}
FROM_POSITIONS = {
    "BOND_INCOME": bond_income,
    "BOND_DEAL_ORGTYPE": bond_deal_orgtype,
    "BOND_DEAL_ORGLIST": bond_deal_orglist,
}
FROM_YIELDS = {
    "BOND_DEAL_TREND_ORG": bond_deal_trend_org,
}
