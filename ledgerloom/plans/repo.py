"""Pledged-repo job: base relations R1, R2, R3 and the fourteen report tables.

The repo side (cash borrower) and the reverse side (cash lender) of every report are
computed together: a deal gives one leg per side, and each side's measures are
conditional sums of one grouped aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import labels
from ledgerloom.functions.measures import (
    extremes, quotient, ratio, rounded, sum_if, weighted_average,
)
from ledgerloom.functions.text import set_text
from ledgerloom.operators import expansion
from ledgerloom.operators.grouping import regroup
from ledgerloom.operators.lookups import (
    flag_listed, keep_listed, lookup, one_per_key, with_root, within,
)
from ledgerloom.plans.inputs import RepoInputs
from ledgerloom.session import broadcast_if_small

REPO, REVERSE = "repo", "rvrse"
SIDES = {REPO: (REPO, REVERSE), REVERSE: (REVERSE, REPO)}
PARTY_COLUMNS = {REPO: "repo_pty_id", REVERSE: "rvrse_repo_pty_id"}
MEMBER_KEYS = ["root_id", "join_type"]


# ---------------------------------------------------------------- base relations

def not_withdrawn(deals: DataFrame, withdrawn: str) -> DataFrame:
    """Status codes compare as text."""
    return deals.where(F.col("st") != withdrawn)


def confirmed_deals(inputs: RepoInputs) -> DataFrame:
    """Deals that are not withdrawn and are on the list of confirmed deals."""
    return keep_listed(not_withdrawn(inputs.deals, inputs.withdrawn), inputs.confirmed, "ev_id")


def with_bank_flag(deals: DataFrame, inputs: RepoInputs) -> DataFrame:
    return flag_listed(deals, inputs.banks, "deal_nmbr", "is_bank_deal")


def with_rating(deals: DataFrame, inputs: RepoInputs) -> DataFrame:
    return lookup(deals, inputs.ratings, "trdng_ri_id", {"rtng_desc": labels.MISSING})


def with_line_count(deals: DataFrame, inputs: RepoInputs) -> DataFrame:
    """Number of collateral lines of a deal, 0 without collateral."""
    lines = inputs.collateral.groupBy("ev_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return lookup(deals, lines, "ev_id", {"n_lines": 0})


def is_money_fund(marker: str) -> Column:
    """Does the member's full name hold the marker of money market funds?"""
    return F.col("full_nm").contains(marker)


def member_profiles(inputs: RepoInputs) -> DataFrame:
    """Members with their root, their kind under it and their validity interval.

    Identifiers are text, since a member without a known root gets the miss marker.
    """
    if inputs.profiles is not None:
        return inputs.profiles
    members = inputs.members.withColumn("unq_id", F.col("unq_id").cast("string"))
    is_fund = is_money_fund(inputs.fund_marker)
    return with_root(members, default=labels.MISSING).select(
        "ip_id", "unq_id", "root_id", "ins_show_name", "efctv_from_dt", "efctv_to_dt",
        expansion.member_kind(F.col("unq_id"), F.col("root_id"), is_fund).alias("kind"),
    )


def with_valid_parties(deals: DataFrame, inputs: RepoInputs) -> DataFrame:
    """Keep deals dated within the validity of both parties and attach both profiles."""
    profiles = broadcast_if_small(member_profiles(inputs))
    for side, party in PARTY_COLUMNS.items():
        member = profiles.alias(side)
        deals = (
            deals.join(
                member,
                (F.col(party) == F.col(f"{side}.ip_id"))
                & within(F.col("deal_dt"), F.col(f"{side}.efctv_from_dt"),
                         F.col(f"{side}.efctv_to_dt")),
            )
            .drop("ip_id", "efctv_from_dt", "efctv_to_dt")
            .withColumnsRenamed({
                c: f"{side}_{c}" for c in ("unq_id", "root_id", "ins_show_name", "kind")
            })
        )
    return deals


def valid_deals(inputs: RepoInputs, rating: bool = False, bank_flag: bool = False,
                line_count: bool = False, confirmed: DataFrame | None = None) -> DataFrame:
    """R1, with the optional attributes a report needs.

    The line count comes first, while the deals are still distributed by their id.
    """
    deals = confirmed_deals(inputs) if confirmed is None else confirmed
    if line_count:
        deals = with_line_count(deals, inputs)
    if bank_flag:
        deals = with_bank_flag(deals, inputs)
    if rating:
        deals = with_rating(deals, inputs)
    return with_valid_parties(deals, inputs)


def reported_products(deals: DataFrame) -> DataFrame:
    """R2: deals in the three reported terms."""
    return deals.where(F.col("pd_cd").isin(*labels.REPORTED_PRODUCTS))


def classified_collateral(inputs: RepoInputs) -> DataFrame:
    """Collateral lines with class and issuer of the bond."""
    return lookup(inputs.collateral, inputs.bonds, "bond_id",
                  {"bond_class": labels.MISSING, "issr_nm": labels.MISSING})


def collateral_lines(deals: DataFrame, inputs: RepoInputs) -> DataFrame:
    """R3: one row per deal and collateral line.

    The amount of a deal repeats on each of its lines and is summed so by the
    reports. Bond attributes join the narrow collateral lines first.
    """
    return deals.join(classified_collateral(inputs), "ev_id")


def pledged_deals(deals: DataFrame) -> DataFrame:
    """R3 at deal level, for reports without bond attributes.

    A deal's amount counts once per collateral line; multiplying by the number of
    lines gives the same sums without the fan-out.
    """
    return deals.where(F.col("n_lines") > 0).withColumn(
        "trade_amnt", F.col("trade_amnt") * F.col("n_lines").cast("decimal(10,0)")
    )


# ---------------------------------------------------------------- grouping

def _sides(deals: DataFrame, keep: list[str], own: list[str], other: list[str] = ()) -> DataFrame:
    return expansion.legs(deals, SIDES, keep, own, other)


def _side_sums(measures: dict[str, Column]) -> list[Column]:
    """<side>_<name> = sum of the measure over that side's legs, null without legs."""
    return [
        sum_if(F.col("side") == side, value).alias(f"{side}_{name}")
        for side in SIDES for name, value in measures.items()
    ]


def _by_member(legs: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """Sums per root member and report group.

    The deals are aggregated per (root, kind, side) first; only those rows are expanded
    into the overlapping report groups, added up again and laid out by side.
    """
    per_kind = legs.groupBy("root_id", "kind", "side", *keys).agg(
        *[F.sum(value).alias(name) for name, value in measures.items()]
    )
    return (
        expansion.expand_join_types(per_kind)
        .groupBy(*MEMBER_KEYS, *keys)
        .agg(*_side_sums({name: F.col(name) for name in measures}))
        .withColumnRenamed("root_id", "unq_id_in_src_sys")
    )


def _by_category(legs: DataFrame, keys: list[str], measures: dict[str, Column],
                 *more: Column) -> DataFrame:
    return legs.groupBy("ins_show_name", *keys).agg(*_side_sums(measures), *more)


def _weigh(deals: DataFrame, column: str) -> DataFrame:
    """Product of value and amount, computed once per deal and not per leg."""
    return deals.withColumn("weighted", F.col(column) * F.col("trade_amnt"))


def _weighted() -> dict[str, Column]:
    return {"weighted": F.col("weighted"), "sum_amount": F.col("trade_amnt")}


def _amount() -> dict[str, Column]:
    return {"sum_amount": F.col("trade_amnt")}


def _average(side: str, name: str) -> Column:
    return ratio(F.col(f"{side}_weighted"), F.col(f"{side}_sum_amount")).alias(f"{side}_{name}")


def spread() -> Column:
    """Reverse price less repo price; null unless both sides traded."""
    price = {side: quotient(F.col(f"{side}_weighted"), F.col(f"{side}_sum_amount")) for side in SIDES}
    return rounded(price[REVERSE] - price[REPO]).alias("price_difference")


# ---------------------------------------------------------------- price reports

def member_price(deals: DataFrame, inputs: RepoInputs) -> DataFrame:
    """MEMBER_PRICE_DEAL_INFO: weighted rate and amount per side, spread and total."""
    deals = _weigh(reported_products(deals), "deal_repo_rate")
    legs = _sides(deals, ["pd_cd", "deal_dt", "weighted", "trade_amnt"], ["root_id", "kind"])
    sums = _by_member(legs, ["pd_cd", "deal_dt"], _weighted())
    return sums.select(
        "unq_id_in_src_sys", "join_type", "pd_cd", "deal_dt",
        _average(REPO, "weighted_price"), "repo_sum_amount",
        _average(REVERSE, "weighted_price"), "rvrse_sum_amount",
        spread(),
        (F.col("repo_sum_amount") + F.col("rvrse_sum_amount")).alias("total_amount"),
    )


def category_price(deals: DataFrame, inputs: RepoInputs) -> DataFrame:
    """CTGRY_PRICE_DEAL_INFO: weighted, greatest and least rate per side and the spread."""
    deals = _weigh(reported_products(deals), "deal_repo_rate")
    legs = _sides(deals, ["pd_cd", "deal_dt", "deal_repo_rate", "weighted", "trade_amnt"],
                  ["ins_show_name"])
    extremes = [
        f(F.when(F.col("side") == side, F.col("deal_repo_rate"))).alias(f"{side}_{name}_deal_repo_rate")
        for side in SIDES for name, f in (("max", F.max), ("min", F.min))
    ]
    sums = _by_category(legs, ["pd_cd", "deal_dt"], _weighted(), *extremes)
    return sums.select(
        "ins_show_name", "pd_cd", "deal_dt",
        _average(REPO, "weighted_price"), _average(REVERSE, "weighted_price"),
        "repo_max_deal_repo_rate", "repo_min_deal_repo_rate",
        "rvrse_max_deal_repo_rate", "rvrse_min_deal_repo_rate", spread(),
    )


def global_price(deals: DataFrame, inputs: RepoInputs) -> DataFrame:
    """GLOBAL_PRICE_DEAL_INFO: rates of the whole market and of bank-to-bank deals."""
    rate, amount, bank = F.col("deal_repo_rate"), F.col("trade_amnt"), F.col("is_bank_deal")
    return reported_products(deals).groupBy("pd_cd", "deal_dt").agg(
        weighted_average(rate, amount, bank).alias("banks_weighted_price"),
        F.max(F.when(bank, rate)).alias("banks_max_deal_repo_rate"),
        F.min(F.when(bank, rate)).alias("banks_min_deal_repo_rate"),
        weighted_average(rate, amount).alias("market_weighted_price"),
        *extremes(rate, "market_", "_deal_repo_rate"),
    )


_COUNTERPARTY_TYPE = "cou_party_ins_show_name"
# Parts in which the other parties of a group are gathered.
SET_PARTS = 64

# ---------------------------------------------------------------- collateral reports

def _member_amounts(legs: DataFrame, keys: list[str]) -> DataFrame:
    return _by_member(legs, keys, _amount())


def _category_amounts(legs: DataFrame, keys: list[str]) -> DataFrame:
    return _by_category(legs, keys, _amount())


def line_legs(lines: DataFrame) -> DataFrame:
    """Both legs of each collateral line, with all that the six line reports group by."""
    lines = _weigh(lines, "cnvrsn_prprtn").withColumnRenamed("bond_class", "bond_ctgry_nm")
    keep = ["bond_ctgry_nm", "rtng_desc", "issr_nm", "deal_dt", "trade_amnt", "weighted"]
    return _sides(lines, [c for c in keep if c in lines.columns], ["root_id", "kind", "ins_show_name"])


def pledged_legs(pledged: DataFrame) -> DataFrame:
    """Both legs of each pledged deal, with the type of the other party."""
    keep = [c for c in ("rtng_desc", "deal_dt", "trade_amnt") if c in pledged.columns]
    legs = _sides(pledged, keep, ["root_id", "kind", "ins_show_name"], ["ins_show_name"])
    return legs.withColumnRenamed("cp_ins_show_name", _COUNTERPARTY_TYPE)


def summed(legs: DataFrame) -> DataFrame:
    """Legs with equal attributes added up: the reports take these rows as well as single legs.

    A job that writes several reports sums once and regroups the sums.
    """
    measures = [c for c in ("trade_amnt", "weighted") if c in legs.columns]
    return legs.groupBy(*[c for c in legs.columns if c not in measures]).agg(
        *[F.sum(c).alias(c) for c in measures])


def member_bond_class(legs: DataFrame, inputs: RepoInputs) -> DataFrame:
    """MEMBER_BOND_CTGRY_DEAL_INFO: amount per collateral class."""
    return _member_amounts(legs, ["bond_ctgry_nm", "deal_dt"])


def category_bond_class(legs: DataFrame, inputs: RepoInputs) -> DataFrame:
    """CTGRY_BOND_CTGRY_DEAL_INFO: amount per collateral class and institution type."""
    return _category_amounts(legs, ["bond_ctgry_nm", "deal_dt"])


def member_rating(legs: DataFrame, inputs: RepoInputs) -> DataFrame:
    """MEMBER_BOND_RTNG_DEAL_INFO: amount per rating."""
    return _member_amounts(legs, ["rtng_desc", "deal_dt"])


def category_rating(legs: DataFrame, inputs: RepoInputs) -> DataFrame:
    """CTGRY_BOND_RTNG_DEAL_INFO: amount per rating and institution type."""
    return _category_amounts(legs, ["rtng_desc", "deal_dt"])


_CONVERSION = "weighted_cnvrsn_prprtn"


def _member_conversion(legs: DataFrame, keys: list[str]) -> DataFrame:
    return _by_member(legs, keys, _weighted()).select(
        "unq_id_in_src_sys", "join_type", *keys,
        _average(REPO, _CONVERSION), "repo_sum_amount",
        _average(REVERSE, _CONVERSION), "rvrse_sum_amount",
    )


def _category_conversion(legs: DataFrame, keys: list[str]) -> DataFrame:
    return _by_category(legs, keys, _weighted()).select(
        "ins_show_name", *keys, _average(REPO, _CONVERSION), _average(REVERSE, _CONVERSION)
    )


def member_bond_type(legs: DataFrame, inputs: RepoInputs) -> DataFrame:
    """MEMBER_BOND_TYPE_DEAL_INFO: conversion ratio and amount per class and rating."""
    return _member_conversion(legs, ["bond_ctgry_nm", "rtng_desc", "deal_dt"])


def category_bond_type(legs: DataFrame, inputs: RepoInputs) -> DataFrame:
    """CTGRY_BOND_TYPE_DEAL_INFO: conversion ratio per class, rating and institution type."""
    return _category_conversion(legs, ["bond_ctgry_nm", "rtng_desc", "deal_dt"])


def member_issuer(legs: DataFrame, inputs: RepoInputs) -> DataFrame:
    """MEMBER_BOND_ISSR_DEAL_INFO: conversion ratio and amount per issuer."""
    return _member_conversion(legs, ["issr_nm", "deal_dt"])


def category_issuer(legs: DataFrame, inputs: RepoInputs) -> DataFrame:
    """CTGRY_BOND_ISSR_DEAL_INFO: conversion ratio per issuer and institution type."""
    return _category_conversion(legs, ["issr_nm", "deal_dt"])


# ---------------------------------------------------------------- counterparty reports

def member_counterparty_amount(legs: DataFrame, inputs: RepoInputs) -> DataFrame:
    """MEMBER_CTGRY_AMOUNT_DEAL_INFO: amount per type of the other party."""
    return _member_amounts(legs, [_COUNTERPARTY_TYPE, "deal_dt"])


def category_counterparty_amount(legs: DataFrame, inputs: RepoInputs) -> DataFrame:
    """CTGRY_CTGRY_AMOUNT_DEAL_INFO: amount per own type and type of the other party."""
    return _category_amounts(legs, [_COUNTERPARTY_TYPE, "deal_dt"])


def member_counterparty_set(pledged: DataFrame, inputs: RepoInputs) -> DataFrame:
    """MEMBER_CTGRY_NUMBER_DEAL_INFO: the other parties of a day, as sorted text.

    Pairs are made distinct before they meet in a group, so a group holds each
    member at most once per side and kind. Members without a root share one group; so sets
    are gathered by a hash of the other party first, and only the reported cell sees them all.
    """
    legs = _sides(pledged, ["deal_dt"], ["root_id", "kind"], ["unq_id", "ins_show_name"])
    pairs = legs.withColumnRenamed("cp_ins_show_name", _COUNTERPARTY_TYPE).distinct()
    keys = [*MEMBER_KEYS, _COUNTERPARTY_TYPE, "deal_dt"]

    def part(side):
        return F.collect_set(F.when(F.col("side") == side, F.col("cp_unq_id"))).alias(side)

    def whole(side):
        return set_text(F.flatten(F.collect_list(side))).alias(f"{side}_cou_party_uniq_set")

    parts = expansion.expand_join_types(pairs).groupBy(
        *keys, F.pmod(F.xxhash64("cp_unq_id"), F.lit(SET_PARTS)).alias("part")).agg(part(REPO), part(REVERSE))
    sets = parts.groupBy(*keys).agg(whole(REPO), whole(REVERSE))
    keys = [_COUNTERPARTY_TYPE, "deal_dt"]
    names = one_per_key(
        inputs.members.select(F.col("unq_id").cast("string").alias("root_id"), "ins_show_name"),
        "root_id")
    return lookup(sets, names, "root_id", {"ins_show_name": labels.MISSING}).select(
        "ins_show_name", F.col("root_id").alias("unq_id_in_src_sys"), "join_type", *keys,
        "repo_cou_party_uniq_set", "rvrse_cou_party_uniq_set",
    )


FROM_DEALS = {
    "MEMBER_PRICE_DEAL_INFO": member_price,
    "CTGRY_PRICE_DEAL_INFO": category_price,
    "GLOBAL_PRICE_DEAL_INFO": global_price,
}
# From the legs of pledged deals and of collateral lines, or from their sums by the columns of
# ``PLEDGED_SETS`` and ``LINE_SETS``.
FROM_PLEDGED_LEGS = {
    "MEMBER_BOND_RTNG_DEAL_INFO": member_rating,
    "CTGRY_BOND_RTNG_DEAL_INFO": category_rating,
    "MEMBER_CTGRY_AMOUNT_DEAL_INFO": member_counterparty_amount,
    "CTGRY_CTGRY_AMOUNT_DEAL_INFO": category_counterparty_amount,
}
FROM_PLEDGED_DEALS = {
    "MEMBER_CTGRY_NUMBER_DEAL_INFO": member_counterparty_set,
}
FROM_LINE_LEGS = {
    "MEMBER_BOND_CTGRY_DEAL_INFO": member_bond_class,
    "CTGRY_BOND_CTGRY_DEAL_INFO": category_bond_class,
    "MEMBER_BOND_TYPE_DEAL_INFO": member_bond_type,
    "CTGRY_BOND_TYPE_DEAL_INFO": category_bond_type,
    "MEMBER_BOND_ISSR_DEAL_INFO": member_issuer,
    "CTGRY_BOND_ISSR_DEAL_INFO": category_issuer,
}

# ---------------------------------------------------------------- one pass for several reports

_MEMBER_SET, _CATEGORY_SET = ["root_id", "kind", "side"], ["ins_show_name", "side"]


def _sets(keys: dict[str, list[str]]) -> dict[str, list[str]]:
    return {name: (_MEMBER_SET if name.startswith("MEMBER") else _CATEGORY_SET) + own for name, own in keys.items()}


PLEDGED_SETS = _sets({
    "MEMBER_BOND_RTNG_DEAL_INFO": ["rtng_desc", "deal_dt"],
    "CTGRY_BOND_RTNG_DEAL_INFO": ["rtng_desc", "deal_dt"],
    "MEMBER_CTGRY_AMOUNT_DEAL_INFO": [_COUNTERPARTY_TYPE, "deal_dt"],
    "CTGRY_CTGRY_AMOUNT_DEAL_INFO": [_COUNTERPARTY_TYPE, "deal_dt"],
})
LINE_SETS = _sets({
    "MEMBER_BOND_CTGRY_DEAL_INFO": ["bond_ctgry_nm", "deal_dt"],
    "CTGRY_BOND_CTGRY_DEAL_INFO": ["bond_ctgry_nm", "deal_dt"],
    "MEMBER_BOND_TYPE_DEAL_INFO": ["bond_ctgry_nm", "rtng_desc", "deal_dt"],
    "CTGRY_BOND_TYPE_DEAL_INFO": ["bond_ctgry_nm", "rtng_desc", "deal_dt"],
    "MEMBER_BOND_ISSR_DEAL_INFO": ["issr_nm", "deal_dt"],
    "CTGRY_BOND_ISSR_DEAL_INFO": ["issr_nm", "deal_dt"],
})
PLEDGED_MEASURES, LINE_MEASURES = ["trade_amnt"], ["trade_amnt", "weighted"]


def pledged_sets(pledged: DataFrame) -> DataFrame:
    """The sums of all reports over pledged deals, routed by report: deals are read once."""
    return regroup(summed(pledged_legs(pledged)), PLEDGED_SETS, PLEDGED_MEASURES)


def line_sets(lines: DataFrame) -> DataFrame:
    """The sums of all reports over collateral lines, routed by report: the fan-out is read once."""
    return regroup(summed(line_legs(lines)), LINE_SETS, LINE_MEASURES)
