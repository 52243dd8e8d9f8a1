"""Miss counters of the two jobs: rows without an entry in a reference table.

Deals without a valid date or amount are counted with them. ``bond_misses`` and ``repo_misses`` are queries
of their own; ``watch_bond`` and ``watch_repo`` take the same counts while a run stages its relations.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import labels
from ledgerloom.operators.lookups import flag_listed
from ledgerloom.operators.quality import Watch, miss_report, misses, misses_at_once
from ledgerloom.plans import bond, repo
from ledgerloom.plans.inputs import BondInputs, RepoInputs


def bond_misses(inputs: BondInputs) -> DataFrame:
    """Misses of the bond job; each party of a deal counts for itself. Deals are read once."""
    marked = flag_listed(inputs.deals, inputs.removed, "bond_deal_id", "_removed", "deal_id")
    marked = flag_listed(marked, inputs.strategies, "deal_nmbr", "_labelled")
    clean = F.coalesce(bond.is_kept(inputs), F.lit(False)) & ~F.col("_removed")
    rates = bond.collateral_rate(inputs.repo_deals, inputs.collateral)
    return miss_report({
        "bond_custodian": misses(inputs.bonds, inputs.orgs, {"cstdtn_bank_id": "unq_id"}),
        "institution_type": _unlabelled(inputs.members, "ins_show_name"),
    }).unionByName(misses_at_once(
        marked, clean,
        {"deal_buyer": (inputs.members, {"buyer_id": "ip_id"}),
         "deal_seller": (inputs.members, {"seller_id": "ip_id"}),
         "collateral_rate": (rates, {"bond_id": "ri_id", "deal_dt": "deal_dt"})},
        {"deal_date": F.col("deal_dt").isNull(), "deal_amount": F.col("trade_amnt").isNull(),
         "deal_strategy": clean & ~F.col("_labelled")}))


def repo_misses(inputs: RepoInputs) -> DataFrame:
    """Misses of the repo job, over confirmed deals, which are gathered once."""
    deals = flag_listed(repo.confirmed_deals(inputs), inputs.ratings, "trdng_ri_id", "_rated")
    rooted = inputs.members.where(
        F.col("rt_member_cd").isNotNull() & (F.col("rt_member_cd").cast("string") != ""))
    return miss_report({
        "member_type": _unlabelled(inputs.members, "ins_show_name"),
        "member_root": misses(rooted, inputs.members, {"rt_member_cd": "member_cd"}),
        "repo_deal_date": _empty(inputs.deals, "deal_dt"),
        "repo_deal_amount": _empty(inputs.deals, "trade_amnt"),
        "collateral_bond": misses(inputs.collateral, inputs.bonds, {"bond_id": "bond_id"}),
    }).unionByName(misses_at_once(
        deals, F.lit(True),
        {"deal_repo_party": (inputs.members, {"repo_pty_id": "ip_id"}),
         "deal_rvrse_party": (inputs.members, {"rvrse_repo_pty_id": "ip_id"})},
        {"deal_product": F.col("pd_cd") == labels.MISSING, "deal_rating": ~F.col("_rated")}))


def _unlabelled(df: DataFrame, label: str) -> DataFrame:
    """Rows whose label was filled in by an earlier lookup that missed."""
    return df.agg(F.count_if(F.col(label) == labels.MISSING).alias("misses"))


def _empty(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("misses"))


# ---------------------------------------------------------------- counted as a run reads

def watch_bond(inputs: BondInputs, watch: Watch) -> BondInputs:
    """Inputs whose counters are taken when bonds, members and clean deals are written."""
    return replace(
        inputs,
        bonds=watch.misses(inputs.bonds, bond_custodian=(inputs.orgs, {"cstdtn_bank_id": "unq_id"})),
        members=watch.rows(inputs.members, institution_type=F.col("ins_show_name") == labels.MISSING),
        deals=watch.rows(inputs.deals, deal_date=F.col("deal_dt").isNull(), deal_amount=F.col("trade_amnt").isNull()))


def watch_clean_deals(deals: DataFrame, inputs: BondInputs, watch: Watch) -> DataFrame:
    return watch.misses(
        deals,
        deal_strategy=(inputs.strategies, {"deal_nmbr": "deal_nmbr"}),
        deal_buyer=(inputs.members, {"buyer_id": "ip_id"}),
        deal_seller=(inputs.members, {"seller_id": "ip_id"}),
        collateral_rate=(inputs.rates, {"bond_id": "ri_id", "deal_dt": "deal_dt"}))


def watch_repo(inputs: RepoInputs, watch: Watch) -> RepoInputs:
    """Inputs whose counters are taken when members and valid deals are written."""
    return replace(
        inputs,
        members=watch.rows(inputs.members, member_type=F.col("ins_show_name") == labels.MISSING),
        deals=watch.rows(inputs.deals, repo_deal_date=F.col("deal_dt").isNull(),
                         repo_deal_amount=F.col("trade_amnt").isNull()))


def watch_profiles(members: DataFrame, inputs: RepoInputs, watch: Watch) -> DataFrame:
    rooted = F.coalesce(F.col("rt_member_cd").cast("string"), F.lit("")) != ""
    return watch.misses(members, where=rooted, member_root=(inputs.members, {"rt_member_cd": "member_cd"}))


def watch_confirmed(deals: DataFrame, inputs: RepoInputs, watch: Watch) -> DataFrame:
    labelled = watch.rows(deals, deal_product=F.col("pd_cd") == labels.MISSING)
    return watch.misses(
        labelled,
        deal_repo_party=(inputs.members, {"repo_pty_id": "ip_id"}),
        deal_rvrse_party=(inputs.members, {"rvrse_repo_pty_id": "ip_id"}),
        deal_rating=(inputs.ratings, {"trdng_ri_id": "trdng_ri_id"}))


def watch_collateral(inputs: RepoInputs, watch: Watch) -> RepoInputs:
    return replace(inputs, collateral=watch.misses(
        inputs.collateral, collateral_bond=(inputs.bonds, {"bond_id": "bond_id"})))
